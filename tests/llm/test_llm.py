"""Every operator on awkward rows, and its query on a whole small table, against brute force."""

import hashlib
import html
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from episodica.llm import byte_bpe, chained_passages, host_consensus, imatch, minhash_tensor, minimax_shards
from episodica.llm import pii_candidates, qgram_decontam, quality_gam, registry, secret_ledger

SF = "/root/testdata/sf0.001"
BODY = " ".join(f"word{i} and more" for i in range(60))
ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t ", "a"), (4, "one two", "b"), (5, BODY, "b"), (6, BODY, "b"), (6, BODY, "b"),
    (None, BODY, None), (8, "x" * 50_000, "c"), (9, BODY.replace("word7 ", "other "), "c"), (10, "é😀  token: 'abcdef123' ", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long, equal and repeated texts, with columns whose names the operators use."""
    rows = [(*r, 0, "k", 1, 1, 0) for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, key string, size long, id long, start int")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def run(spark, name):
    return registry.QUERIES[name](spark, SF).collect()


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


# --- 1 fingerprints


def test_imatch_query(spark, documents):
    ids = sorted(documents, reverse=True)
    got = {r.doc_id: r for r in run(spark, "op1_imatch")}
    assert sorted(got) == sorted(documents)
    by_text = defaultdict(set)
    for k, i in enumerate(ids):
        text, following = documents[i], documents[ids[(k + 1) % len(ids)]]
        n = len(text) // 3
        assert got[i].edited_sha256 == sha(text[: len(text) - n] + following[:n]) and got[i].n_chars == len(text)
        by_text[text].add(got[i].fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
    assert np.mean([r.near_edited for r in got.values()]) > 0.2 + np.mean([r.near_next for r in got.values()])


def test_imatch_odd(odd, none):
    rows = imatch.fingerprints(odd).collect()
    assert len(rows) == len(ODD) and imatch.fingerprints(none).count() == 0
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[1] == prints[2] == prints[3] == "0" * len(prints[1]) and prints[5] == prints[6] == prints[None]
    assert {r.near_edited for r in rows if r.doc_id == 1} == {1.0}


# --- 2 secrets


def base_secrets(text):
    rules = {
        "assign": (r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
    }
    spans = []
    for k, (name, (pattern, good)) in enumerate(rules.items()):
        flags = re.I | re.A if name == "assign" else 0
        spans += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text, flags) if good(m)]
    return ",".join(f"{n}:{a}:{b}" for a, _, b, n in sorted(spans))


def test_secrets_query(spark, documents):
    rows = run(spark, "op2_secret_ledger")
    assert {r.doc_id: r.base_sha256 for r in rows} == {i: sha(base_secrets(t)) for i, t in documents.items()}


def test_secret_spans():
    pieces = ["token=token=abcdef", "PassWD : 'abc", "api_key=\"abcdef0123\"", "AKIA" + "Z" * 15, "AKIA" + "A1" * 9, "0af" * 9, " ", "é"]
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 7)))
        spans = [s for s in secret_ledger.find_spans(text) if s[0] in secret_ledger.BASE]
        assert secret_ledger.written(spans) == base_secrets(text)


def test_ledger_scans_unseen_only(spark, odd, none, tmp_path):
    ledger = str(tmp_path / "ledger")
    assert secret_ledger.findings(odd, ledger).count() == len(ODD)
    secret_ledger.scan(odd, ledger)
    blobs = len({t or "" for _, t, _ in ODD})
    assert secret_ledger.open_ledger(spark, ledger).count() == blobs
    secret_ledger.scan(odd.union(odd.limit(1).withColumn("text", F.lit("new"))), ledger)
    secret_ledger.scan(none, ledger)
    assert secret_ledger.open_ledger(spark, ledger).count() == blobs + 1
    secret_ledger.scan(odd, ledger, rules="2")
    assert secret_ledger.open_ledger(spark, ledger).count() == 2 * blobs + 1
    out = {r.doc_id: r.text for r in secret_ledger.masked(odd, ledger).collect()}
    assert out[10] == "é😀  [secret]' " and out[5] == BODY and out[1] is None


# --- 3 pages


def test_pages_query(spark):
    def main(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", article))
        return "\n".join(b for b in blocks if b)

    pages = {r.page_id: main(r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = run(spark, "op3_host_consensus")
    assert {r.page_id: r.text for r in rows} == pages and all(r.n_chars == len(r.text) for r in rows)


def test_pages_odd(spark):
    page = (
        "<html><body><header>Top</header><div class='menu-2'><a href=x>Home</a></div><div id=main><div class=post><h1>T &amp; t</h1><p>One\n two<br>three"
        "<p>Four <b>five</b><ul><li>six<li>seven</ul><form>Mail</form></div></div><div class='comment-list'><p>Nice words of a reader</p></div>"
        "<aside>More</aside><footer>End</footer></body></html>"
    )
    rows = [(1, "https://A.b/c", page), (2, None, None), (3, "http://a.b", ""), (4, "x", "no tags < at all"), (5, "http://a.b", "<p title='open"), (1, "https://A.b/c", page)]
    df = spark.createDataFrame([(*r, "p") for r in rows], "page_id long, url string, html string, path string")
    out = host_consensus.main_text(df).collect()
    texts = defaultdict(list)
    for r in out:
        texts[r.page_id].append(r.text)
    assert texts[1] == ["T & t\nOne two three\nFour five\nsix\nseven"] * 2
    assert texts[2] == texts[3] == [""] and texts[4] == ["no tags < at all"] and len(out) == 6
    assert host_consensus.main_text(df.where("false")).count() == 0


# --- 4 personal data


@pytest.mark.parametrize("begin", ['<div class="page has-sidebar">', '<main class="content with-comments">', '<article class="post no-ads">', '<div id="social-policy">', '<div class="ads">'])
def test_class_of_the_whole_article(begin):
    text = "The text of this article goes on for quite a while and has no links."
    page = f'<html><body>{begin}<p>{text}</p><div class="sidebar"><p>Aside.</p></div><div class="site-footer"><p>Foot.</p></div></{begin[1:].split()[0]}></body></html>'
    path = max(votes := host_consensus.votes(page), key=votes.get)
    assert host_consensus.extract(page, path).split("\n")[0] == text
    assert begin == '<div class="ads">' or host_consensus.extract(page, path) == text


def base_pii(text):
    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    rules = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: max(map(int, m.split("."))) <= 255),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    )
    return ",".join(f"{n}:{m.start()}:{m.end()}" for n, p, good in rules for m in re.finditer(p, text) if good(m[0]))


def test_pii_query(spark, documents):
    rows = run(spark, "op4_pii_candidates")
    assert {r.doc_id: r.base_sha256 for r in rows} == {i: sha(base_pii(t)) for i, t in documents.items()}


def test_pii_odd(spark, odd, none):
    rng = random.Random(2)
    bits = ["a@b.c", "_d@e.ff", "1.2.3.4", ".5", "300.", "+1 (2", "34) 567-8901", "4111 1111 1111 1111", "4111-", " ", "é😀", "x", "@", "0001"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 9))) for _ in range(150)] + ["1" * 20_000 + "a" * 20_000 + "@b" + ".c" * 9_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.base for r in pii_candidates.detected(df).select("doc_id", pii_candidates.written("base").alias("base")).collect()}
    assert got == {i: base_pii(t) for i, t in enumerate(texts)}
    assert pii_candidates.detected(odd).count() == len(ODD) and pii_candidates.detected(none).count() == 0


def test_pii_loose_forms(spark):
    texts = ["mail ann@site.org or call +49 30 5557713", "write to bob [at] host [dot] com", "office (017) 555-7713 is open", "at 300.1.1.1 and 4111 1111 1111 1112"] * 20
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii_candidates.detected(df).select("doc_id", pii_candidates.written("spans").alias("spans")).collect()}
    assert [got[i] for i in range(4)] == ["email:5:17,phone:26:40", "email_loose:9:32", "phone_loose:7:21", ""]


# --- 5 decontamination


def test_decontamination(spark, odd, none):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: " ".join(r.text.lower().split()) for r in bench.collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    flat = {r.doc_id: " ".join((r.text or "").lower().split()) for r in docs.collect()}
    exact = {(i, k) for i, t in flat.items() for k, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in run(spark, "op5_qgram_decontam")}
    assert exact <= got and len(got) <= len(exact) + 2
    in_blocks = {(r.doc_id, r.item_id) for r in qgram_decontam.contaminated(docs, bench, block_chars=1500).collect()}
    assert in_blocks == got
    assert {r.doc_id for r in qgram_decontam.keep_clean(docs, bench).collect()} == set(flat) - {i for i, _ in got}
    assert qgram_decontam.contaminated(odd, bench).count() == 0 and qgram_decontam.keep_clean(odd, bench).count() == len(ODD)
    assert qgram_decontam.contaminated(none, bench).count() == 0 and qgram_decontam.contaminated(docs, bench.where("false")).count() == 0


def test_edited_items():
    rng = random.Random(3)
    item = "the quick brown fox jumps over a lazy dog while seven wizards mix a strong potion in the old cellar of the tower"
    items = qgram_decontam.index([7], [item])
    for _ in range(200):
        x = list(item)
        for _ in range(rng.randint(0, int(items.budget[0]))):
            p = rng.randrange(len(x))
            if rng.random() < 0.5:
                x[p] = "z"
            else:
                del x[p]
        if len("".join(x).split()) != len(item.split()):
            continue  # white space counts as one: more or fewer edits than were made
        text = "Some words before. " * rng.randint(0, 3) + "".join(x).upper() + " and some after."
        (hit,) = qgram_decontam.matches(items, [text])[0]
        assert abs(hit[1] - text.index("".join(x).upper())) <= 8 and hit[3] <= items.budget[0]
    assert qgram_decontam.matches(items, [item[:60] + " something else entirely"]) == [[]]


# --- 6 shards


def best_capacity(sizes, shards):
    def needed(c):
        n, filled = 1, 0
        for s in sizes:
            if s > c:
                return 10**9
            n, filled = (n + 1, s) if filled + s > c else (n, filled + s)
        return n

    return next(c for c in range(1, sum(sizes) + 2) if needed(c) <= shards)


def test_capacity_is_smallest(spark):
    rng = random.Random(4)
    for hot in (0, 400):
        sizes = [(rng.getrandbits(64) - (1 << 63), rng.randint(1, 30)) for _ in range(60)] + ([(5, hot)] if hot else [])
        capacity, cuts = minimax_shards.find_cuts(spark.createDataFrame(sizes, "order_key long, size long"), 8)
        ordered = [s for _, s in sorted((k % (1 << 64), s) for k, s in sizes)]
        assert capacity == best_capacity(ordered, 8) and len(cuts) <= 7


def test_shards_query(spark, documents):
    rows = run(spark, "op6_minimax_shards")
    shard = {r.doc_id: r.shard for r in rows}
    by_text, slots, total = defaultdict(set), defaultdict(list), defaultdict(int)
    for r in rows:
        raw = documents[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "bytes")
        by_text[raw].add(shard[r.doc_id])
        slots[r.shard].append(r.slot)
        total[r.shard] += r.size
    assert len(rows) == len(documents) and all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(8))
    assert max(total.values()) < 1.2 * sum(total.values()) / 8


def test_shards_odd(odd, none):
    rows = minimax_shards.sharded(odd).collect()
    assert len(rows) == len(ODD) and len({r.shard for r in rows if r.size == 1}) == 1
    assert minimax_shards.sharded(none).count() == 0


# --- 7 tokens


def test_tokens(spark, documents, odd, none):
    path = public_tokenizers.path(byte_bpe.VOCABULARY)
    coder = byte_bpe.ByteBpe(path)
    ours = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={})
    assert sorted(coder.hash.places(list(coder.ranks)).tolist()) == list(range(len(coder.ranks)))
    rng = random.Random(5)
    texts = ["", "  ", "a" * 5000, "don't 'll  \n x <|endoftext|>", *["".join(rng.choice("ab e'\n\t\x1c　é漢1٣½😀!") for _ in range(40)) for _ in range(500)]]
    assert all(coder.encode(t) == ours.encode_ordinary(t) and coder.decode(coder.encode(t)) == t.encode() for t in texts)
    for r in run(spark, "op7_byte_bpe"):
        ids = ours.encode_ordinary(documents[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(documents[r.doc_id]))
    rows = byte_bpe.decoded(byte_bpe.encoded(odd, path), path).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in rows) == sorted(repr((i, t or "")) for i, t, _ in ODD)
    assert byte_bpe.encoded(none, path).count() == byte_bpe.round_trip(none, path).count() == 0


# --- 8 quality


def test_quality(spark, odd, none):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = {r.doc_id: r for r in quality_gam.op8_quality_gam(spark, sf).collect()}
    known = {r.doc_id: r.quality for r in labels.collect()}
    out = {i for i in rows if zlib.crc32(str(i).encode()) % 4 == 2}
    assert {i for i, r in rows.items() if r.held_out} == out and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    judged = [rows[i].predicted == known[i] for i in out & set(known)]
    assert np.mean(judged) > 0.95
    ids = {r.doc_id for r in quality_gam.learnable(labels.union(labels.selectExpr("null", "quality", "toxic"))).collect()}
    assert not ids & out and ids <= set(known)
    model = quality_gam.train(odd, labels.where("false"))
    assert {r.score for r in quality_gam.score(odd, model).collect()} == {0.5} and quality_gam.score(none, model).count() == 0
    assert quality_gam.keep_good(odd, model, 0.5).count() == len(ODD) and quality_gam.keep_good(odd, model).count() == 0


# --- 9 passages


def test_chain_is_best():
    rng = random.Random(6)
    for _ in range(100):
        n = rng.randint(1, 12)
        x, y = (np.sort(np.array([rng.randint(0, 40) for _ in range(n)])), np.array([rng.randint(0, 40) for _ in range(n)]))
        best = [0.0] * n
        for i in range(n):
            before = [best[j] - chained_passages.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(n) if x[j] < x[i] and y[j] < y[i]]
            best[i] = chained_passages.K + max([0.0, *before])
        found = chained_passages.chains(x, y)
        if found:
            c = found[0]
            assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
            score = chained_passages.K * len(c) - chained_passages.GAP_COST * ((x[c[-1]] - x[c[0]]) + (y[c[-1]] - y[c[0]]))
            assert score <= max(best) + 1e-9


def test_passages(spark, odd, none):
    rng = random.Random(7)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    shared = words(70)
    fuzzy = shared.split()
    fuzzy[20], fuzzy[50] = "new", "other"
    docs = [(1, words(80) + " " + shared + " " + words(30)), (2, words(20) + "\n" + shared), (3, " ".join(fuzzy) + " " + words(9)), (4, words(120)), (5, words(60) + " " + shared[:200])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows = chained_passages.passages(df).collect()
    assert {(r.doc_id, r.partner_id) for r in rows} == {(2, 1), (3, 1)}
    text = dict(docs)
    for r in rows:
        assert text[1][r.partner_start : r.partner_end] == shared and r.similarity >= 0.9
        assert text[r.doc_id][r.start : r.end] == (shared if r.doc_id == 2 else " ".join(fuzzy))
    pairs = {(r.doc_id, r.partner_id) for r in chained_passages.passages(odd).collect()}
    assert pairs == {(6, 5), (9, 5)} and chained_passages.passages(none).count() == 0


def passage_rows(spark, *docs):
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    return chained_passages.passages(df).collect()


def some_words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]


@pytest.mark.parametrize("others", [1, 9])
def test_passage_whose_parts_have_smaller_holders(spark, others):
    rng = random.Random(8)
    x, y = some_words(rng, 40), some_words(rng, 40)
    docs = [(i, some_words(rng, 9) + x + some_words(rng, 30)) for i in range(others)]
    docs += [(100 + i, some_words(rng, 30) + y + some_words(rng, 9)) for i in range(others)]
    rows = passage_rows(spark, *docs, (200, some_words(rng, 20) + x + y + some_words(rng, 7)), (201, some_words(rng, 33) + x + y))
    assert [(r.doc_id, r.partner_id, r.words) for r in rows] == [(201, 200, 80)]


def test_later_copies_and_repeated_words(spark):
    rng = random.Random(9)
    p, q = some_words(rng, 55), some_words(rng, 60)
    copies = [w for _ in range(3) for w in p + some_words(rng, 70)]
    twice = some_words(rng, 9) + q + some_words(rng, 30) + q
    docs = [(1, some_words(rng, 9) + p + some_words(rng, 9)), (2, copies), (3, twice), (4, ["ha"] * 70 + some_words(rng, 5)), (5, some_words(rng, 5) + ["ha"] * 70)]
    rows = passage_rows(spark, *docs)
    assert sorted(r.start for r in rows if (r.doc_id, r.partner_id) == (2, 1)) == [k * len(" ".join(copies[:125]) + " ") for k in range(3)]
    assert [(r.words, r.end <= r.start, r.partner_end <= r.start) for r in rows if (r.doc_id, r.partner_id) == (3, 3)] == [(60, False, True)]
    assert (5, 4) in {(r.doc_id, r.partner_id) for r in rows}


@pytest.mark.parametrize("every", [5, 6, 7])
def test_passages_down_to_least_similarity(spark, every):
    rng = random.Random(every)
    docs = []
    for i in range(30):
        p = some_words(rng, 60)
        changed = ["x" + w if k % every == i % every else w for k, w in enumerate(p)]
        docs += [(2 * i, some_words(rng, 20) + p + some_words(rng, 20)), (2 * i + 1, some_words(rng, 12) + changed + some_words(rng, 15))]
    assert {(r.doc_id, r.partner_id) for r in passage_rows(spark, *docs)} == {(2 * i + 1, 2 * i) for i in range(30)}


@pytest.mark.parametrize("cell", [1024, 16])
def test_passage_of_common_seeds_only(spark, monkeypatch, cell):
    """Every seed of a passage has many other places, whose documents hold single runs of it."""
    monkeypatch.setattr(chained_passages, "CELL", cell)
    rng = random.Random(11)
    p = some_words(rng, 60)
    changed = ["x" + w if k % 6 == 5 else w for k, w in enumerate(p)]
    docs = [(i, some_words(rng, 9) + [w for k in np.random.default_rng(i).permutation(10) for w in [*p[6 * k : 6 * k + 5], *some_words(rng, 12)]]) for i in range(40)]
    docs += [(100, some_words(rng, 20) + p + some_words(rng, 20)), (200, some_words(rng, 12) + changed + some_words(rng, 15))]
    rows = passage_rows(spark, *docs)
    assert [(r.doc_id, r.partner_id) for r in rows] == [(200, 100)] and rows[0].words >= 50 and rows[0].similarity >= 0.8


def test_windows_of_common_seeds():
    """Every window of enough equal words that a place shares with a smaller one is linked, where their run of equal words begins."""
    rng = np.random.default_rng(12)
    cp = chained_passages
    base = rng.integers(1, 1 << 63, 140, dtype=np.uint64)
    texts = []
    for _ in range(60):
        words = np.where(rng.random(140) < rng.choice([0.05, 0.2, 0.4]), rng.integers(1, 1 << 63, 140, dtype=np.uint64), base)
        words[60 : 60 + cp.K] = base[60 : 60 + cp.K]
        texts.append(words)
    codes = np.concatenate([cp.words_around(w, np.array([60])) for w in texts])
    rows = np.stack([np.arange(60), np.full(60, 60)], 1)
    one = np.zeros(60, np.int64)
    found = cp.same_windows(rows, one, codes, one)
    partners = {}
    for i, j, x, y, kind in found.tolist():
        assert x == y and kind == cp.WINDOW
        partners.setdefault(i, set()).add(j)
    seen = 0
    for i in range(60):
        for start in range(60 - cp.BEFORE, 61):
            share = [j for j in range(i) if (texts[i] == texts[j])[start : start + cp.MIN_WORDS].sum() >= 40]
            seen += bool(share)
            assert not share or partners.get(i, set()) & set(share)
    assert seen and all(len(p) <= cp.WINDOWS for p in partners.values())
    same = np.full(60, 5)
    assert not len(cp.same_windows(rows, same, codes, one))


def test_passages_leave_no_shuffles(spark):
    """The shuffles of the steps go when these are done: at most the last one needs disk besides what is written."""
    rng = random.Random(13)
    shared = [some_words(rng, 60) for _ in range(40)]
    docs = [(i, " ".join(some_words(rng, 300) + shared[i % 40] + some_words(rng, 300))) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    size = lambda: {(f := files.apply(k)).getName(): f.length() for files in [disk.getAllFiles()] for k in range(files.size())}
    before = size()
    found = chained_passages.passages(df)
    left = sum(n for name, n in size().items() if name.startswith("shuffle") and name not in before)
    assert left < 0.3 * sum(len(t) for _, t in docs)
    assert {r.doc_id for r in found.collect()} == set(range(40, 300))


def test_parts_hold_texts(spark):
    texts = [(1, ""), (2, "Ä é  ß\U0001f600 a"), (2, "other"), (3, "w " * (1 << 20)), (None, "x"), (4, "\u2028 y")]
    df = spark.createDataFrame(texts, "id long, text string").coalesce(1)
    parts = chained_passages.numbered(df).toArrow()
    got = [(i, t) for _, ids, found in chained_passages.texts_in(parts) for i, t in zip(ids, found)]
    assert got == texts and parts.num_rows == 2 and len(set(parts.column("part").to_pylist())) == 2
    assert sum(parts.column("chars").to_pylist()) == sum(len(t) for _, t in texts)


def test_alignment_in_pieces():
    """Words in common by trimmed ends, and words between seeds all at once, agree with the plain way."""
    rng = random.Random(14)

    def plain(a, b):
        row = [0] * (len(b) + 1)
        for w in a:
            row = [0] + [0] * len(b) if not row else row
            new = [0]
            for k, o in enumerate(b):
                new.append(max(new[-1], row[k + 1], row[k] + (w == o)))
            row = new
        return row[-1]

    for _ in range(200):
        a, b = (np.array([rng.randint(0, 3) for _ in range(rng.randint(0, 9))], np.int64) for _ in range(2))
        assert chained_passages._edit_matches(a, b) == plain(a, b)
        x = np.array(sorted(rng.sample(range(60), rng.randint(1, 30))))
        chain = chained_passages.chains(x, x + 7)
        tree, score, previous = [], [0.0] * len(x), [-1] * len(x)
        cost = (chained_passages.GAP_COST * (2 * x + 7)).tolist()
        chained_passages._best_before(x.tolist(), list(range(1, len(x) + 1)), cost, score, previous)
        used = set()
        for i in sorted(range(len(x)), key=lambda i: (-score[i], i)):
            one = []
            while i >= 0 and i not in used:
                used.add(i)
                one.append(i)
                i = previous[i]
            tree += [one[::-1]] if len(one) >= chained_passages.MIN_SEEDS else []
        # Gaps of more than MAX_GAP words end chains besides; such costs leave none.
        assert [c.tolist() for c in chain] == tree


def test_longest_chain_first():
    """What lies inside a passage of its document is not aligned; what reaches as far as it is."""
    words = " ".join(some_words(random.Random(15), 200))
    side = lambda n, i, a, b: {"side": n, "id": i, "chain": 0, "places": np.arange(a, b - 3), "low": 0, "first": 0, "piece": words}
    taken = []
    whole = chained_passages._aligned([side(0, 9, 0, 200), side(1, 1, 0, 200)], taken)
    assert [r[1:3] for r in whole] == taken == [(0, len(words))]
    assert len(chained_passages._aligned([side(0, 9, 50, 150), side(1, 2, 50, 150)], taken)) == 1
    assert not chained_passages._aligned([side(0, 9, 50, 150), side(1, 2, 50, 150)], [(0, len(words) + 1)])


# --- 10 near duplicates


def components_of(texts, width=4):
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(*[w[k:] for k in range(width)])) if len(w) >= width else {tuple(w)} if w else set()
    top = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top[a], top[b]))
                top = {i: x if t == y else t for i, t in top.items()}
    return {i: (len(sets[i]), top[i], top[i] == i) for i in ids}


def test_near_duplicates_query(spark, documents):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in run(spark, "op10_minhash_tensor")}
    assert got == components_of(documents)


def test_near_duplicates_hard(spark):
    """Chains of altered copies without a common centre, and near misses."""
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 999)}" for _ in range(80)]
    texts, now = {}, list(base)
    for i in range(40):
        texts[i] = " ".join(now)
        source = now if i % 3 else base
        now = list(source)
        for _ in range(rng.randint(1, 3)):
            now[rng.randrange(len(now))] = f"n{rng.randint(0, 10**6)}"
    texts |= {40: "Two Words", 41: "two words", 42: "", 43: " "}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash_tensor.near_duplicates(df).collect()}
    assert got == components_of(texts)


def test_near_duplicates_odd(odd, none):
    rows = minhash_tensor.near_duplicates(odd).collect()
    assert len(rows) == len(ODD) and minhash_tensor.near_duplicates(none).count() == 0
    of = {r.doc_id: r.component_id for r in rows}
    assert of[None] is None and of[6] == of[9] == 5 and [of[i] for i in (1, 2, 3, 4, 8, 10)] == [1, 2, 3, 4, 8, 10]
    kept = minhash_tensor.keep_one(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "None", "8", "10"])


# --- pipeline


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text or "" for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name == "near_dedup":
            assert {r.doc_id for r in out.collect()} == {i for i, (_, _, kept) in components_of(before, 5).items() if kept}
        if name == "mask_secrets":
            assert {r.doc_id for r in out.collect() if r.text != before[r.doc_id]} == {i for i, t in before.items() if secret_ledger.find_spans(t)}
        if k < 4:
            assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out, "stage")
    assert docs.count() == len(before) and corpus_pipeline.run(spark, SF).count() == len(before)
