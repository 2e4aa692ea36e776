"""Operators against their SQL, and cases that earlier versions missed."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from episodica.llm import minimax_shards, quality_gam, registry, secret_ledger
from episodica.llm.common import bitmap

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_secret_ledger", "op10_minhash_tensor"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    result = con.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    assert Counter(tuple(r) for r in registry.QUERIES[name](spark, SF).select(*names).collect()) == Counter(result.fetchall())


def test_sql_knows_every_kind_of_secret(spark, tmp_path):
    """The SQL and the operator on texts with all kinds, side by side, overlapping and at both ends."""
    key = "-----BEGIN RSA PRIVATE KEY-----\nabc+/=\n-----END RSA PRIVATE KEY-----"
    jwt = "eyJ" + "a" * 9 + ".eyJ" + "b-" * 6 + "." + "c_" * 9
    texts = [key, f"x{key} {key}", jwt, f" {jwt} x{jwt}, {jwt}", f"é😀token: '{'0af' * 9}' {jwt}", "AKIA" + "Z9" * 8 + jwt, "API-key=abcdef apiKEY = \"abcdef0\"", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    result = con.execute(registry.ORACLE["op2_secret_ledger"])
    names = [d[0] for d in result.description]
    got = secret_ledger.op2_secret_ledger(spark, str(tmp_path)).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(result.fetchall())
    assert {s.split(":")[0] for r in got for s in r.spans.split(",") if s} == set(secret_ledger.KINDS)


def test_only_unseen_texts_pass(spark, tmp_path):
    """With a ledger, the readers let through the unseen texts and hardly another, and copies count once."""
    docs = spark.createDataFrame([(k, f"text {k % 500} token=abcdef{k % 500}") for k in range(1500)], "doc_id long, text string")
    ledger = str(tmp_path / "ledger")
    secret_ledger.scan(docs.where("doc_id % 500 < 490"), ledger)
    assert secret_ledger.open_ledger(spark, ledger).count() == 490
    unseen = docs.where("doc_id % 500 >= 490").select(F.conv(F.hex(F.substring(secret_ledger._blob(docs, "text"), 1, 7)), 16, 10).cast("long").alias("key"))
    held = bitmap(unseen, "key")
    seen = docs.where("doc_id < 490").select(secret_ledger._blob(docs, "text").alias("b")).collect()
    assert sum(bool(held.holds(np.array([int.from_bytes(r.b[:7], "big")], np.uint64))[0]) for r in seen) < 100
    secret_ledger.scan(docs, ledger)
    secret_ledger.scan(docs, ledger)
    assert secret_ledger.open_ledger(spark, ledger).count() == 500
    assert secret_ledger.findings(docs, ledger).where(F.size("found_spans") == 1).count() == 1500


def test_clashing_names(spark, tmp_path):
    rows = [(1, "token=abcdef", 7, b"b", 3, "s"), (2, None, 8, b"b", 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, found_spans long, versions_blob binary, versions_salt int, key string")
    ledger = str(tmp_path / "ledger")
    secret_ledger.scan(docs, ledger)
    out = {r.doc_id: r for r in secret_ledger.masked(docs, ledger).collect()}
    assert out[1].text == "[secret]" and out[2].text is None and out[1].found_spans == 7 and bytes(out[2].versions_blob) == b"b" and out[1].key == "s"
    named = secret_ledger.findings(docs, ledger, name="hits")
    assert named.columns == [*docs.columns, "hits"]
    with pytest.raises(ValueError):
        secret_ledger.findings(docs, ledger)
    only = docs.select("text")
    assert secret_ledger.findings(only, ledger).count() == 2 and secret_ledger.findings(only.where("false"), ledger).count() == 0


def test_the_end_of_a_text_counts():
    at = {n: k for k, n in enumerate(quality_gam.FEATURES)}
    plain = "the words of a plain text go on and on without an end " * 20
    upper = quality_gam.text_features(plain[:512] + "A" * 480)
    assert upper[at["worst_upper"]] > 0.9
    symbol = quality_gam.text_features(plain[:600] + "#|!" * 150)
    assert symbol[at["worst_symbol"]] > 0.8
    words = quality_gam.text_features(plain[:300] + " ha" * 40)
    assert words[at["worst_repeat"]] > 0.9
    assert quality_gam.text_features("")[at["worst_upper"]] == quality_gam.text_features("a")[at["worst_repeat"]] == 0.0


@pytest.mark.parametrize("hot", [0.0, 0.05, 0.3])
def test_few_segments_are_opened(spark, monkeypatch, hot):
    """Whatever a hot group weighs, few segments come to the driver, and the capacity is still the smallest."""
    groups = spark.range(60_000).select(F.xxhash64("id").alias("order_key"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900)) + 1).alias("size"))
    total = groups.agg(F.sum("size")).first()[0]
    if hot:
        groups = groups.union(spark.createDataFrame([(123456789, int(total * hot / (1 - hot)))], "order_key long, size long"))
    groups = groups.persist()
    opened = []
    real = minimax_shards.segment_totals
    monkeypatch.setattr(minimax_shards, "segment_totals", lambda g, o=None: opened.append(len(o or ())) or real(g, o))
    capacity, cuts = minimax_shards.find_cuts(groups, 8)
    assert sum(opened) <= 400
    ordered = [s for _, s in sorted((r.order_key % (1 << 64), r["size"]) for r in groups.collect())]

    def needed(c):
        n, filled = 1, 0
        for s in ordered:
            n, filled = (n + 1, s) if filled + s > c else (n, filled + s)
        return n if max(ordered) <= c else 10**9

    assert needed(capacity) <= 8 < needed(capacity - 1) and len(cuts) <= 7
    groups.unpersist()
