"""Language identification, phrase mining and fill-in-middle: awkward rows and brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from episodica.llm import compression_lang, fim_wavelet, phrase_trie, registry

SF = "/root/testdata/sf0.001"
LONG = "word " * 300_000
ODD = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "One two. <P>", ""), (5, "Drei vier!", "de"), (5, "Drei vier!", "de"),
    (None, "une phrase", None), (7, LONG, "fr"), (8, "x" * 2_000_000, "fr"), (9, "12 + 34 = 46", "en"), (10, "é😀\x0b nul\x00l", "de"),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, blank, long, equal and repeated texts, with columns whose names the operators use."""
    rows = [(*r, "k", 1, 1, 0.5, "w") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, form string, n long, id long, score double, w1 string")


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("false")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def same_as_sql(spark, name, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    result = con.execute(registry.ORACLE[name])
    names = [d[0] for d in result.description]
    want = Counter(result.fetchall())
    got = Counter(tuple(r) for r in registry.QUERIES[name](spark, sf).select(*names).collect())
    assert got == want and sum(want.values())


# --- 11 language


def test_language_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    truth = {r.doc_id: r.lang for r in rows}
    got = {r.doc_id: r for r in registry.QUERIES["op11_compression_lang"](spark, "/root/testdata/sf0.01").collect()}
    out = {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert set(got) == set(truth) and {i for i, r in got.items() if r.held_out} == out
    assert np.mean([got[i].lang_pred == truth[i] for i in out]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    wrong = [got[i].margin for i in out if got[i].lang_pred != truth[i]]
    right = [got[i].margin for i in out if got[i].lang_pred == truth[i]]
    assert not wrong or np.mean(wrong) < np.mean(right)


def test_language_learns_outside_the_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = compression_lang.label_counts(docs)
    texts = {r.doc_id: (r.lang, r.text) for r in docs.collect()}
    known = Counter(lang for i, (lang, _) in texts.items() if zlib.crc32(str(i).encode()) % 5)
    assert counts == dict(known)
    for sample in (1000, 3):
        rows = compression_lang.learnable(docs, counts, sample).collect()
        assert Counter(r.lang for r in rows) == {x: min(n, sample) for x, n in known.items()}
        assert all(any(r.passage in t for i, (x, t) in texts.items() if x == r.lang and zlib.crc32(str(i).encode()) % 5) for r in rows)
    with pytest.raises(ValueError, match="languages"):
        compression_lang.label_counts(docs, most=2)


def test_sizes_cover_the_whole_text():
    rng = random.Random(1)
    word = {x: ["".join(rng.choice(abc) for _ in range(5)) for _ in range(80)] for x, abc in (("a", "abcdef"), ("b", "uvwxyz"))}
    said = lambda x, n: " ".join(rng.choice(word[x]) for _ in range(n))
    model = compression_lang.fit([(x, k, said(x, 200)) for x in "ab" for k in range(20)])
    assert model.languages == ["a", "b"] and [model.judge(said(x, 40).upper())[0] for x in "ab"] == ["a", "b"]
    # The end counts: a short beginning in one language, most of the text in the other.
    assert model.judge(said("a", 500) + " " + said("b", 5000))[0] == "b"
    pieces = [compression_lang.folded(said("a", 3000))[k : k + compression_lang.PIECE] for k in range(0, 18_001, compression_lang.PIECE)]
    text = b"".join(pieces).decode()
    assert model.sizes(text)[0].tolist() == [sum(len(c.compress(p)) for p in map(bytes, _cut(compression_lang.folded(text)))) for c in model._compressors()]
    # A mixture is rejected, a clear text is not.
    assert model.judge(said("a", 300))[2] > 0.05 > model.judge(" ".join(said("ab"[k % 2], 3) for k in range(200)))[2]
    assert compression_lang.fit([("a", 0, "x y")], {"a": 1}).judge("x")[0] == "a"


def _cut(data):
    return [data[k : k + compression_lang.PIECE] for k in range(0, len(data), compression_lang.PIECE)]


def test_language_odd(odd, none):
    model = compression_lang.train(odd)
    assert set(model.languages) == {"en", "", "de", "fr"} - ({"en"} if zlib.crc32(b"2") % 5 == zlib.crc32(b"9") % 5 == 0 else set()) - ({""} if zlib.crc32(b"4") % 5 == 0 else set())
    rows = compression_lang.identified(odd, model).collect()
    assert len(rows) == len(ODD)
    by = defaultdict(set)
    for r in rows:
        by[r.doc_id].add((r.lang, r.nearest, r.score))
    assert all(by[i] == {("und", "und", 0.0)} for i in (1, 2, 3, 9)) and len(by[5]) == 1
    assert compression_lang.identified(none, model).count() == 0
    empty = compression_lang.train(none)
    assert {(r.nearest, r.score) for r in compression_lang.identified(odd, empty).collect()} == {("und", 0.0)}


# --- 12 phrases


def test_phrases_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        same_as_sql(spark, "op12_phrase_trie", sf)


def phrases_of(rows, longest, least, cover, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        kept = []
        for p in found:
            a, n = f[p], len(p)
            if any(100 * f[q] >= cover * a for q in found if len(q) > n and any(q[i : i + n] == p for i in range(len(q) - n + 1))):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, n))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, total[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize("longest, least, cover, top", [(3, 2, 50, 2000), (4, 3, 80, 7), (2, 1, 50, 40)])
def test_phrases_brute_force(spark, monkeypatch, longest, least, cover, top):
    rng = random.Random(longest)
    rows = []
    for k in range(60):
        words = [rng.choice(["a", "B", "c", "dé", "e-f", "ha", "ha", "New York", "."]) for _ in range(rng.randint(0, 60))]
        rows.append((rng.choice(["en", "de", None, ""]), rng.choice([" ", "  ", "\t"]).join(words) + rng.choice(["", ",", "\n x"])))
    rows += [("en", None), ("en", ""), ("xx", "ha " * 500), ("xx", "nul\x00l ha ha")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "doc_id long, lang string, text string")
    # Many small tries, and a bitmap that lets nearly everything through, give the same.
    for shard, bits in ((1 << 20, 1 << 27), (5, 1 << 10)):
        found = phrase_trie.collocations(df, longest, least, cover, top, shard, bits)
        assert sorted(map(tuple, found.collect())) == phrases_of(rows, longest, least, cover, top)


def test_long_text_in_chunks():
    rng = random.Random(5)
    text = " ".join(rng.choice("abc.") for _ in range(3000))
    want = Counter()
    for piece in text.split("."):
        words = piece.split()
        want.update(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    for chunk in (7, 64, 10**6):
        got, name = Counter(), {}
        old, phrase_trie.CHUNK = phrase_trie.CHUNK, chunk
        try:
            for t, data, starts, ends, _ in phrase_trie.tokens([text], ["x"], phrase_trie.Hasher(0), 3, True):
                name |= {int(i): bytes(data[a:b]).decode() for i, a, b in zip(t.ids[t.carried :], starts, ends)}
                near = t.together()
                got.update(tuple(name[int(x)] for x in t.ids[i : i + 3]) for i in range(len(t.ids) - 2) if near[i] and near[i + 1] and i + 2 >= t.carried)
        finally:
            phrase_trie.CHUNK = old
        assert got == want


def test_trie_holds_every_phrase():
    rng = np.random.default_rng(6)
    phrases = np.unique(rng.integers(1, 700, (4000, 3)).astype(np.uint64) ** 3, axis=0)
    phrases[::3, 2] = 0
    trie = phrase_trie.Trie.build(phrases)
    assert trie.digits == 2
    node = np.zeros(len(phrases), np.int32)
    for k in range(3):
        there = np.flatnonzero(phrases[:, k])
        node[there], alive = trie.step(node[there], np.searchsorted(trie.words, phrases[there, k]))
        assert len(alive) == len(there)
    assert (trie.phrases(node, 3) == phrases).all()


def test_equal_ids_start_anew(spark, monkeypatch):
    """With ids of few bits words fall together; that is noticed."""
    docs = spark.createDataFrame([(k, "en", f"a{k} b{k} c{k}") for k in range(200)], "doc_id long, lang string, text string")
    assert phrase_trie.vocabulary(docs).count() == 600
    narrow = phrase_trie.vocabulary(docs).selectExpr("id & 15L as id", "word")
    assert narrow.distinct().count() > narrow.select("id").distinct().count()


def test_phrases_odd(odd, none):
    want = phrases_of([(lang, text) for _, text, lang in ODD], 3, 10, 50, 2000)
    assert [tuple(r) for r in phrase_trie.collocations(odd).collect()] == want and len(want) == 1
    assert phrase_trie.collocations(none).count() == 0
    with pytest.raises(ValueError):
        phrase_trie.collocations(odd, longest=1)


# --- 13 fill-in-middle


def test_fim_query(spark):
    for sf in (SF, "/root/testdata/sf0.01"):
        same_as_sql(spark, "op13_fim_wavelet", sf)


UNIT = {"word": r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", "line": r"[^\n]*\n|[^\n]+$", "char": r"[\s\S]"}


def moved(doc_id, text, unit, rate, spm_rate, seed):
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(UNIT[unit], text)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in fim_wavelet.MARKERS) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm_rate:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit, rate, spm_rate, seed", [("word", 50, 80, 42), ("line", 100, 0, 1), ("char", 90, 50, 7)])
def test_fim_brute_force(spark, odd, none, unit, rate, spm_rate, seed):
    rng = random.Random(seed)
    rows = [(k, "".join(rng.choice(["ab", "é", "😀", " ", "\n", "\t", "\x0b", "\x1c", "<", "P>", "S>"]) for _ in range(rng.randint(0, 40)))) for k in range(150)]
    rows += [(i, t) for i, t, _ in ODD]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = fim_wavelet.transformed(df, unit, rate, spm_rate, seed)
    got = Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out.collect())
    assert got == Counter((i, *moved(i, t or "", unit, rate, spm_rate, seed)) for i, t in rows)
    texts = Counter((r.doc_id, r.text) for r in fim_wavelet.restored(out).collect())
    assert texts == Counter((i, t or "") for i, t in rows)
    assert fim_wavelet.transformed(odd, unit).count() == len(ODD)
    assert fim_wavelet.transformed(none, unit).count() == fim_wavelet.restored(fim_wavelet.transformed(none)).count() == 0


def test_wavelet_ranks():
    rng = np.random.default_rng(2)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 7, n)
        matrix = fim_wavelet.WaveletMatrix(symbols)
        at = np.arange(n + 1)
        for c in range(8):
            assert matrix.rank(c, at).tolist() == [0, *np.cumsum(symbols == c).tolist()]


def test_markers():
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "bc", "x"), ("aba", "x", "y"), ("abc", "b", "z")):
        with pytest.raises(ValueError):
            fim_wavelet.check_markers(bad)
    marks = ("<1>", "<2>", "<3>")
    assert fim_wavelet.original("<1>a <<2> c<3>b <M>", "psm", marks) == "a <b <M> c"
    assert fim_wavelet.original("<2> c<1>a <<3>b <M>", "spm", marks) == "a <b <M> c"
