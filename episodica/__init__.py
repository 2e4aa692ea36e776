"""Spark-native engine for episodes of robot steps: check, index, align, store, replay."""

from episodica.plans.check import check_stores
from episodica.plans.convert import convert
from episodica.plans.replay import replay

__all__ = ["check_stores", "convert", "replay"]
