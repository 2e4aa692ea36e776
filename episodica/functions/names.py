"""Names of datasets, cameras, stores and exports, as column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sanitize_repo_id(repo_id: Column) -> Column:
    return F.replace(repo_id, F.lit("/"), F.lit("__"))


def camera_slug(camera_key: Column) -> Column:
    return F.replace(camera_key, F.lit("."), F.lit("_"))


def parse_store_name(stem: Column) -> Column:
    """struct(split, slug), cut at the first ``__``; both null without one."""
    at = F.locate("__", stem)
    return F.struct(
        F.when(at > 0, F.substring(stem, F.lit(1), at - 1)).alias("split"),
        F.when(at > 0, F.substring(stem, at + 2, F.length(stem))).alias("slug"),
    )


def match_camera(slug: Column, requested: Column) -> Column:
    """True if the slug is the requested camera, given as a key or as a slug."""
    return (slug == camera_slug(requested)) | (slug == requested)


def store_name(split: Column, camera_key: Column) -> Column:
    return F.concat(split, F.lit("__"), camera_slug(camera_key))


def store_path(root: str, repo_id: Column, split: Column, camera_key: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), sanitize_repo_id(repo_id), store_name(split, camera_key))


def export_name(stem: Column, ep_pos: Column) -> Column:
    """Name of one episode's signal export."""
    return F.format_string("%s__ep%d", stem, ep_pos)
