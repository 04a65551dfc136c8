"""op11 to op13 against brute force, and their edge rows."""

import gzip
import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001


# -- op11 ------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, who int, payload string, digest string, copy int"


def _page(i, url, html):
    return (i, url, html, 0, "x", "y", 7)


def test_surt_orders_hosts_backwards():
    from argent.llm.warc import surt
    assert surt("https://www.Example.com:443/a b?x=1#f") == "com,example,www)/a%20b?x=1"
    assert surt("http://example.com:8080") == "com,example:8080)/"
    assert surt(None) == "" and surt("no url") == "no%20url" and surt("http://[bad/") == "http://[bad/"


def test_warc_round_trip(spark):
    from argent.llm.warc import archive_pages
    long = "<p>é" + "x" * 300_000 + "</p>\r\n\r\nWARC/1.1"
    same = "s" * 100
    data = [_page(5, "http://b.com/", same), _page(3, "http://a.com/", same), _page(9, None, same), _page(1, "http://a.com/", "t" * 99), _page(2, "http://a.com/", "t" * 99),
            _page(4, "http://a.com/\n", None), _page(6, "x y", ""), _page(7, "http://c.org/l", long), _page(3, "http://a.com/", same), _page(3, "http://z.com/", same),
            _page(None, "http://n.org/", same), _page(None, None, "n" * 200), _page(None, None, "n" * 200)]
    out = archive_pages(spark.createDataFrame(data, PAGES).repartition(5), payload=True).collect()
    assert len(out) == len(data)
    assert Counter((r.page_id, r.payload_bytes) for r in out) == Counter((i, len((h or "").encode())) for i, _, h, *_ in data)
    by = Counter((r.page_id, r.url, r.record_type, r.refers_to) for r in out)
    assert by[(3, "http://a.com/", "response", None)] == 1 and by[(3, "http://a.com/", "revisit", 3)] == 1 and by[(3, "http://z.com/", "revisit", 3)] == 1
    assert by[(5, "http://b.com/", "revisit", 3)] == 1 and by[(9, None, "revisit", 3)] == 1 and by[(None, "http://n.org/", "revisit", 3)] == 1
    assert by[(None, None, "response", None)] == 1 and by[(None, None, "revisit", None)] == 1
    assert by[(1, "http://a.com/", "response", None)] == 1 and by[(2, "http://a.com/", "response", None)] == 1 and by[(4, "http://a.com/%0A", "response", None)] == 1
    assert {r.html for r in out if r.page_id == 7} == {long}


def test_warc_index_lookup_and_files(spark, tmp_path):
    from argent.llm.warc import build_index, open_index, parse_record, read_captures, write_archives
    root = f"file:{tmp_path}/argent"
    pages = spark.createDataFrame([_page(i, f"http://h{i % 7}.example.com/p{i % 50}", f"<p>{i}</p>") for i in range(500)], PAGES)
    captures = write_archives(pages, root)
    build_index(captures, root, lines=16)
    index = open_index(spark, root)
    assert index.parts == sorted(index.parts) and len(index.parts) > 1
    ask = spark.createDataFrame([("https://h3.example.com/p3#x",), ("http://h3.example.com/p3",), ("http://h3.example.com/p",), ("http://none/",), (None,)], "url string")
    got = read_captures(index.lookup(ask), root).collect()
    want = [i for i in range(500) if i % 7 == 3 and i % 50 == 3]
    assert sorted(int(r.id) for r in got) == want and all(r.html == f"<p>{r.id}</p>" for r in got)
    # the archives are plain WARC: every gzip member is a record
    names = os.listdir(tmp_path / "argent/archives")
    text = b"".join(gzip.open(tmp_path / "argent/archives" / n).read() for n in names)
    assert text.count(b"WARC-Type: response") == 500 and text.count(b"WARC-Type: warcinfo") == len(names)
    row = captures.first()
    with open(tmp_path / "argent/archives" / row.archive, "rb") as f:
        f.seek(row.offset)
        headers, _ = parse_record(f.read(row.length))
    assert headers["warc-payload-digest"] == f"sha256:{row.payload_digest}"


def test_warc_empty_table(spark):
    from argent.llm.warc import archive_pages
    assert archive_pages(spark.createDataFrame([], PAGES)).count() == 0


# -- op12 ------------------------------------------------------------------


def _words(rows, letters=6, least=5, drop=199):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if drop and h % drop == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= letters:
                found[w] += 1
    return {w: n for w, n in found.items() if n >= least}


def _one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[p + (len(a) == len(b)):] == b[p + 1:]


def _variants(words):
    out = {}
    for w, n in words.items():
        near = [x for x in words if _one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def _got(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_sorted_list_finds_one_edit():
    from argent.llm.spelling import SortedList
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abÿ", k=rng.randint(1, 6))) for _ in range(400)} | {""})
    look = SortedList(words)
    for q in [*words, "aaaaaaa", "c", "cab"]:
        assert [words[i] for i in look.near(q)] == [w for w in words if _one_edit(q, w)], q


@pytest.mark.parametrize("group", [400, 3])
def test_near_words_brute_force(spark, group):
    from argent.llm.spelling import near_words
    rng = random.Random(5)
    words = {"".join(rng.choices("abé", k=rng.randint(1, 9))): rng.choice([5, 6, 25, 30, 125, 700]) for _ in range(700)}
    words |= {"prefixprefix" + "".join(rng.choices("xyz", k=3)): rng.choice([5, 25, 125]) for _ in range(40)}
    words |= {"".join(rng.choices("xyz", k=2)) + "samesuffix": 9 for _ in range(9)}
    df = spark.createDataFrame([*words.items(), ("", 3), (None, 4)], "word string, n bigint")
    assert _got(near_words(df, group=group)) == _variants(words)


def test_word_counts(spark):
    from argent.llm import spelling
    rng = random.Random(7)
    base = ["Straße", "étudier", "running", "runing", "x×y÷zab", "abcdef", "ABCDEF", "abc…def", "Ünïcødé", "short", "😀letters"]
    rows = [(i, " ".join(rng.choices(base, k=60))) for i in range(300)] + [(7, "abcdef, " * 40), (None, "abcdef runing"), (1, None), (2, ""), (1000, "abcdef-" * 5000 + "q" * 9000)]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, word int, n int").repartition(4)
    for drop in (199, 7, None):
        got = {r.word: r.n for r in spelling.word_counts(df, drop_one_in=drop).collect()}
        assert got == _words(rows, drop=drop)


def test_pieces_cut_between_words(monkeypatch):
    from argent.llm import spelling
    monkeypatch.setattr(spelling, "PIECE", 5)
    for data in (b"aa bb cccccccccccc d  e", b"", b"     ", b"abcdefghij", b" a b c "):
        assert [w for p in spelling._pieces(data) for w in p] == data.split()


def test_op12_query(spark):
    from argent.llm.queries import op12_spelling
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    assert _got(op12_spelling(spark, SF0001)) == _variants(_words(docs))


def test_spelling_empty(spark):
    from argent.llm.spelling import near_words, word_counts
    assert near_words(word_counts(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0


# -- op13 ------------------------------------------------------------------


def _negatives(rows, every, p=5, n=3):
    """rows: {id: (label, ints)}"""
    out = []
    for a, (label, e) in rows.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(e, f)) for b, (_, f) in rows.items() if b != a and len(f) == len(e)}
        for q in sorted((b for b in score if rows[b][0] == label), key=lambda b: (-score[b], b))[:p]:
            found = [b for b in score if rows[b][0] != label and 50 * score[q] <= 100 * score[b] <= 95 * score[q]]
            for k, b in enumerate(sorted(found, key=lambda b: (-score[b], b))[:n]):
                out.append((a, q, k + 1, b, score[q], score[b]))
    return sorted(out)


VECTORS = "vec_id bigint, embedding array<float>, label int, e int, d int, side int"


def test_strassen_is_exact():
    from argent.llm.negatives import strassen
    rng = np.random.default_rng(1)
    for n, k, m in ((1, 1, 1), (33, 65, 17), (64, 64, 64), (130, 31, 99), (5, 200, 40)):
        a, b = rng.integers(-2**28, 2**28, (n, k)), rng.integers(-2**28, 2**28, (k, m))
        assert (strassen(a, b, 4) == a.astype(object) @ b.astype(object)).all()


def test_heaps_merge_like_a_sort():
    from argent.llm.negatives import NONE, Heaps
    rng = np.random.default_rng(2)
    score = rng.integers(-3, 3, (20, 90))
    score[rng.random((20, 90)) < 0.3] = NONE
    score[0] = NONE
    ids = np.sort(rng.choice(1000, 90, replace=False))
    heaps = Heaps(20, 4)
    for cut in np.split(rng.permutation(90), [20, 50]):
        cut = np.sort(cut)
        heaps.add(score[:, cut].copy(), ids[cut])
    for r in range(20):
        want = sorted(((-s, i) for s, i in zip(score[r].tolist(), ids.tolist()) if s != NONE))[:4]
        assert [(-s, i) for s, i in zip(heaps.score[r].tolist(), heaps.id[r].tolist()) if s != NONE] == want


@pytest.mark.parametrize("blocks", [(2048, 8192, 1024), (3, 16, 8)])
def test_hard_negatives_brute_force(spark, monkeypatch, blocks):
    from argent.llm import negatives
    for name, v in zip(("ANCHORS", "CANDIDATES", "TILE"), blocks):
        monkeypatch.setattr(negatives, name, v)
    rng = random.Random(4)
    data, rows = [], {}
    for i in range(160):
        dim = 5 if i % 8 else 3
        v = [rng.choice([-0.51, 0.2, 0.5, 0.75, 1.0]) for _ in range(dim)]
        data.append((i, v, i % 3 if i < 80 else 0, 1, 2, 3))
        rows[i] = (data[-1][2], [int(np.floor(256 * float(np.float32(x)))) for x in v])
    rows[10] = (rows[10][0], [0] * 5)
    data[10] = (10, [0.0] * 5, data[10][2], 1, 2, 3)
    bad = [(200, None, 1), (210, [1.0, None, 1.0, 1.0, 1.0], 1), (220, [float("nan")] * 5, 1), (230, [float("inf")] * 5, 0), (240, [1.0] * 5, None), (None, [1.0] * 5, 1), (250, [], 1)]
    df = spark.createDataFrame([*data, *data[:20], *[(*b, 1, 2, 3) for b in bad]], VECTORS).repartition(3)
    got = sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0).collect())
    assert got == _negatives(rows, 5) and got


def test_hard_negatives_edges(spark):
    from argent.llm.negatives import hard_negatives
    assert hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 5 == 0).count() == 0
    assert hard_negatives(spark.createDataFrame([(5, [1.0], 1, 0, 0, 0)], VECTORS), F.col("vec_id") % 5 == 0).count() == 0
    # two rows with one id: the same stands in either order
    two = [(5, [1.0], 1, 0, 0, 0), (5, [2.0], 1, 0, 0, 0), (6, [1.0], 1, 0, 0, 0), (7, [0.75], 2, 0, 0, 0)]
    a, b = (sorted(map(tuple, hard_negatives(spark.createDataFrame(x, VECTORS), F.col("vec_id") % 5 == 0).collect())) for x in (two, two[::-1]))
    assert a == b and len(a) == 1
    with pytest.raises(Exception, match="too long for exact scores"):
        hard_negatives(spark.createDataFrame([(5, [1e9], 1, 0, 0, 0)], VECTORS), F.col("vec_id") % 5 == 0).count()


def test_op13_query(spark):
    from argent.llm.queries import op13_negatives
    rows = {}
    for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect():
        if r.label is not None and r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding):
            rows[r.vec_id] = ((r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, [int(np.floor(256 * x)) for x in r.embedding])
    assert sorted(tuple(r) for r in op13_negatives(spark, SF0001).collect()) == _negatives(rows, 50)


# -- op1: the last pass and repeated ids ---------------------------------------


def _sets(text, words):
    w = (text or "").lower().split()
    return {tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def _components(sets, percent=80):
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in sets}


def _near_copies(members, rng, length=60, changes=3):
    base = [f"w{i}" for i in range(length)]
    out = []
    for i in range(members):
        w = list(base)
        for at in rng.sample(range(length), changes):
            w[at] = f"x{rng.randrange(10 ** 6)}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("rounds", [0, 3])
def test_near_duplicates_of_a_group_match_brute_force(spark, monkeypatch, rounds):
    from argent.llm import minhash
    monkeypatch.setattr(minhash, "BLOCK", 32)
    rows = _near_copies(150, random.Random(1))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(df, words=2, star_rounds=rounds).collect()}
    want = _components({i: _sets(t, 2) for i, t in rows})
    assert got == want and 1 < len(set(want.values())) < 150


def test_links_of_a_group_grow_with_its_members(spark, monkeypatch):
    from argent.llm import minhash
    real, rows = minhash.stored, {}

    def stored(df, name="stage"):
        out = real(df, name)
        if name == "links":
            rows[members] = rows.get(members, 0) + out.count()
        return out
    monkeypatch.setattr(minhash, "stored", stored)
    for members in (400, 1600):
        df = spark.createDataFrame(_near_copies(members, random.Random(2), changes=1), "doc_id bigint, text string")
        minhash.near_duplicates(df, words=2, star_rounds=0).count()
    assert 399 <= rows[400] < 40 * 400 and rows[1600] < 5 * rows[400]


def test_one_id_with_two_texts_in_either_order(spark):
    from argent.llm.minhash import near_duplicates
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a), (2, a), (2, b), (3, b), (3, b)]
    results = []
    for data in (rows, rows[::-1], rows[2:] + rows[:2]):
        df = spark.createDataFrame([(*r, 0, 0) for r in data], "doc_id bigint, text string, rep int, component_id int").coalesce(1)
        results.append(sorted(tuple(r) for r in near_duplicates(df, words=2).collect()))
    assert results[0] == results[1] == results[2] and len(results[0]) == 5
    component = {r[0]: r[2] for r in results[0]}
    assert component in ({1: 1, 2: 1, 3: 3}, {1: 1, 2: 2, 3: 2})


# -- op3 and op7: names that clash, null and repeated ids ------------------------


def test_line_dedup_keeps_columns_of_any_name(spark):
    from argent.llm.line_dedup import line_dedup
    text = "one a\ntwo b\nthree c"
    names = ["_gone", "_k1", "_k2", "_h", "_lines", "gone", "lines", "row", "order", "w", "idx", "place", "h1", "a.b"]
    df = spark.createDataFrame([(i, t, *[i] * len(names)) for i, t in ((1, text), (2, f"x\n{text}"))], ["doc_id", "text", *names])
    out = {r[0]: tuple(r) for r in line_dedup(df).collect()}
    assert out == {1: (1, text, *[1] * len(names), 3, 0), 2: (2, "x", *[2] * len(names), 4, 3)}


def test_mixing_meets_its_targets_with_null_and_repeated_ids(spark):
    from argent.llm.mixing import mix, mixing_plan
    names = ["_source", "draw", "of_source", "_copy", "copy", "row", "a.b"]
    rows = [(None if i % 2 else 7, f"w{i % 50} " * 9, f"s{i % 3}", *[i] * len(names)) for i in range(3000)]
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names]).repartition(5)
    plan = mixing_plan(df)
    assert set(names) <= set(plan.columns)
    for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert abs(r.taken - r.target) < 0.05 * r.target
    again = mixing_plan(df.repartition(9))
    total = lambda p: sorted(map(tuple, p.groupBy("doc_id", "text").agg(F.sum("copies")).collect()), key=repr)
    assert total(plan) == total(again)
    out = mix(df)
    assert out.columns == df.columns and out.count() == plan.agg(F.sum("copies")).first()[0]
