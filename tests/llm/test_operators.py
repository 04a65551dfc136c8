"""Operators against brute force on small fixtures and on the sf0.001 tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF0001

TEXTS = [(1, "the cat sat on the mat and the dog ran " * 9), (2, "the cat sat on the mat and the dog ran " * 9), (3, None), (4, ""),
         (5, "  \t\n "), (6, "one"), (7, "a b " * 3000), (None, "nobody owns this text, yet it stays."), (6, "one"),
         (9, "line one here\nline two here\nline three here\nline four"), (10, "x\nline one here\nline two here\n\nline three here\ny"),
         (11, "Ünïcödé ﬁ ß 中文 Σ ΑΣ <|endoftext|> it's"), (12, "  two  spaces ▁ mark\x00\x1c ")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None if i == 6 else f"s{(i or 0) % 3}", 0, 1) for i, t in TEXTS],
                                 "doc_id long, text string, lang string, source string, n_chars long, KEPT int")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def got(df):
    return [r.asDict() for r in df.collect()]


def real(spark):
    return spark.read.parquet(f"{SF0001}/documents.parquet")


def test_quality_rules(spark, docs):
    from argent.llm.quality_rules import quality_rules
    for df in (docs, real(spark).select("doc_id", "text")):
        for r in got(quality_rules(df)):
            w, t = words(r["text"]), r["text"] or ""
            seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
            covered = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
            lines = [x for x in t.split("\n") if words(x)]
            want = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))
            assert want == tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
            assert r["base_failed"] == (len(w) < 20 or 100 * len(covered) > 30 * len(w))
            assert not (r["kept"] and r["base_failed"])


def test_quality_keeps_clean_labelled(spark):
    from argent.llm.quality_rules import quality_rules
    label = spark.read.parquet(f"{SF0001}/labels.parquet")
    rows = got(quality_rules(real(spark)).join(label, "doc_id").select("quality", "kept", "base_failed"))
    assert all(r["kept"] for r in rows if r["quality"] == 1 and not r["base_failed"])
    assert sum(r["kept"] for r in rows if r["quality"] == 0) <= 0.15 * sum(r["quality"] == 0 for r in rows)


def test_near_duplicates(spark, docs):
    from argent.llm.minhash import near_duplicates
    df = docs.select("doc_id", "text").unionByName(real(spark).where("doc_id > 12").select("doc_id", "text"))
    rows = got(near_duplicates(df, words=2))
    sets = {}
    for i, t in [(r["doc_id"], r["text"]) for r in got(df)]:
        w = (t or "").encode().lower().split()
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else set(w)
    comp = {i: i for i in sets}
    for _ in range(4):
        for a in sets:
            for b in sets:
                if None not in (a, b) and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    for r in rows:
        assert r["component_id"] == comp[r["doc_id"]] and r["n_shingles"] == len(sets[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] is None or r["component_id"] == r["doc_id"])


def test_near_vectors(spark):
    from argent.llm.embeddings import near_vectors
    v = spark.read.parquet(f"{SF0001}/embeddings.parquet").limit(300)
    odd = spark.createDataFrame([(-1, None, 1), (-2, [0.0] * 64, 1), (-3, [float("nan")] * 64, 1), (-4, [1.0] * 64, None),
                                 (-5, [1.0] * 64, 1), (-6, [2.0] * 64, 1), (-7, [1.0, 2.0], 1), (-8, [], 1)],
                                "vec_id long, embedding array<float>, label int")
    rows = {r["vec_id"]: r for r in got(near_vectors(v.unionByName(odd)))}
    assert rows[-5]["n_links"] == 1 and rows[-5]["component_id"] == -6 and all(rows[i]["n_links"] == 0 for i in (-1, -2, -3, -4, -7, -8))
    links = Counter()
    data = got(v)
    for x in data:
        for y in data:
            if x["vec_id"] != y["vec_id"] and x["label"] == y["label"]:
                a, b = np.array(x["embedding"], float), np.array(y["embedding"], float)
                links[x["vec_id"]] += a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.93
    assert all(rows[x["vec_id"]]["n_links"] == links[x["vec_id"]] for x in data)


def test_near_vectors_of_mixed_lengths(spark):
    from argent.llm.embeddings import near_vectors
    rows = [(i, [1.0, 0.01 * i, 0.0] if i % 2 else [1.0, 0.0, 0.01 * i, 0.02, 0.0], 1) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    # every vector of a label in one cell: both lengths would share each bucket
    for r in got(near_vectors(df, tables=2, k=1, width=1e6)):
        assert (r["n_links"], r["component_id"], r["kept"]) == (9, 2 - r["vec_id"] % 2, r["vec_id"] < 3)


def test_near_vectors_of_repeated_ids(spark):
    from argent.llm.embeddings import near_vectors
    rows = [(1, [1.0, 0.0], 1)] * 5 + [(2, [1.0, 0.01], 1)] * 3 + [(3, [2.0, 0.0], 1)] + [(4, [0.0, 1.0], 1), (4, None, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in got(near_vectors(df)))
    assert found == {(1, 2, 1, True): 5, (2, 2, 1, False): 3, (3, 2, 1, False): 1, (4, 0, 4, True): 2}
    both = spark.createDataFrame([(5, [1.0, 0.0], 1), (5, [0.0, 1.0], 1), (6, [1.0, 0.0], 1), (7, [0.0, 1.0], 1)],
                                 "vec_id long, embedding array<double>, label int")
    found = [Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in got(near_vectors(x))) for x in (both, both.orderBy(F.desc("vec_id")))]
    assert found[0] == found[1] and found[0][5, 1, 5] == 2


def test_line_dedup(spark, docs):
    from argent.llm.line_dedup import line_dedup
    rows = {r["doc_id"]: r for r in got(line_dedup(docs))}
    assert rows[9]["text"] == TEXTS[9][1] and rows[9]["n_lines"] == 4
    assert rows[10]["text"] == "x\n\ny" and rows[10]["n_removed_lines"] == 3
    assert rows[3]["text"] is None and rows[4]["text"] == "" and rows[5]["text"] == "  \t\n "
    assert line_dedup(docs.limit(0)).count() == 0


def test_lm_scores(spark, docs):
    from argent.llm.lm_score import lm_scores
    df = real(spark).where("doc_id > 12").select("doc_id", "text").unionByName(docs.select("doc_id", "text").where("doc_id in (3, 4) or doc_id is null"))
    target = df.where("doc_id % 3 = 0").select(F.col("doc_id").alias("id"))
    rows = got(lm_scores(df, target))
    texts = [(r["doc_id"], (r["text"] or "").encode().lower().split()) for r in got(df)]
    all_ = Counter(w for _, x in texts for w in x)
    vocab = {w for w, n in all_.items() if n >= 2}
    coded = [(i, [w if w in vocab else 0 for w in x]) for i, x in texts]

    def model(keep):
        two, ctx, one = Counter(), Counter(), Counter()
        for i, x in coded:
            if keep(i):
                for a, b in zip([1, *x], x):
                    two[a, b] += 1
                    ctx[a] += 1
                    one[b] += 1
        n = sum(one.values())
        return lambda a, b: math.log((two[a, b] + 100 * (one[b] + 1) / (n + len(vocab) + 2)) / (ctx[a] + 100))
    t, b = model(lambda i: i is not None and i % 3 == 0), model(lambda i: True)
    want = {i: (len(x), sum(b(p, q) - t(p, q) for p, q in zip([1, *x], x)) / len(x) if x else None) for i, x in coded}
    assert len(rows) == len(texts)
    for r in rows:
        n, s = want[r["doc_id"]]
        assert r["n_tokens"] == n and (r["score"] is None if s is None else abs(r["score"] - s) < 1e-9)


def test_lm_scores_keep_rare_words_of_a_large_corpus(spark, monkeypatch):
    from argent.llm import lm_score
    monkeypatch.setattr(lm_score, "BLOCK", 20_000)  # many blocks, and counts that go back to several
    monkeypatch.setattr(lm_score, "ADDED", 5_000)   # in many parts
    texts = [(i, "the of and to " * 2500 + f"word{i % 7} " * 2 + f"term{i % 15} once{i}") for i in range(40)] + [(None, "the of"), (99, ""), (98, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    rows = got(lm_score.lm_scores(df, df.where("doc_id < 10").select(F.col("doc_id").alias("id"))))
    count = Counter(w for _, t in texts for w in (t or "").split())
    assert 1e-5 * sum(count.values()) > 3 and min(n for w, n in count.items() if w.startswith("term")) < 4
    coded = [(i, [w if count[w] >= 2 else 0 for w in (t or "").split()]) for i, t in texts]
    size = sum(n >= 2 for n in count.values())

    def model(keep):
        two, ctx, one = Counter(), Counter(), Counter()
        for i, x in coded:
            if keep(i):
                two.update(zip([1, *x], x))
                ctx.update([1, *x][:-1] if x else [])
                one.update(x)
        n = sum(one.values())
        return lambda a, b: math.log((two[a, b] + 100 * (one[b] + 1) / (n + size + 2)) / (ctx[a] + 100))
    t, b = model(lambda i: i is not None and i < 10), model(lambda i: True)
    want = {i: (len(x), [-sum(m(p, q) for p, q in zip([1, *x], x)) / len(x) if x else None for m in (t, b)]) for i, x in coded}
    assert len(rows) == len(texts)
    for r in rows:
        n, losses = want[r["doc_id"]]
        assert r["n_tokens"] == n
        for name, v in zip(("target_loss", "background_loss"), losses):
            assert r[name] is None if v is None else abs(r[name] - v) < 1e-9


def test_lm_scores_without_words_or_rows(spark):
    from argent.llm.lm_score import lm_scores
    df = spark.createDataFrame([(1, "", 0, 0), (2, None, 0, 0), (2, " \n", 0, 0)], "doc_id long, text string, block int, n int")
    assert [(r.n_tokens, r.score) for r in lm_scores(df, df.select(F.col("doc_id").alias("id"))).collect()] == [(0, None)] * 3
    assert lm_scores(df.limit(0), df.select(F.col("doc_id").alias("id"))).count() == 0


@pytest.mark.parametrize("ranges", [None, 17])
def test_drop_repeats(spark, docs, ranges):
    from argent.llm.suffix_dedup import drop_repeats
    df = docs.select("doc_id", "text").unionByName(real(spark).where("doc_id > 12").select("doc_id", "text"))
    rows = got(drop_repeats(df, with_text=True, seed_ranges=ranges))
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in got(df)]
    where = defaultdict(int)
    for _, t in texts:
        for k in range(len(t) - 199):
            where[t[k:k + 200]] += 1
    want = Counter()
    for i, t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - 199):
            if where[t[k:k + 200]] > 1:
                gone[k:k + 200] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone[:-1]])
        want[i, len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest(), kept] += 1
    assert want == Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"], bytes(r["kept"])) for r in rows)


def test_mixing(spark, docs):
    from argent.llm.mixing import mix, mixing_plan
    for df in (docs, real(spark)):
        rows = got(mixing_plan(df))
        size = Counter()
        for r in rows:
            assert r["size"] == len(words(r["text"])) and r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"]
            size[r["source"]] += r["size"]
        names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        left, free, want = 1.5 * sum(size.values()), set(names), {}
        while free:  # stop sources at twice their size, share the excess again
            level = left / sum(weight[s] for s in free)
            full = {s for s in free if level * weight[s] > 2 * size[s]}
            if not full:
                want |= {s: level * weight[s] for s in free}
                break
            want |= {s: 2.0 * size[s] for s in full}
            left -= sum(2.0 * size[s] for s in full)
            free -= full
        for r in rows:
            assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]]
        assert mix(df).count() == sum(r["copies"] for r in rows) and mix(df).columns == df.columns
    assert mixing_plan(docs.limit(0)).count() == 0


def test_bpe_equals_library(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer
    from argent.llm.bpe import bpe_decode, bpe_encode, bpe_round_trip
    path = public_tokenizers.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    for df in (docs, real(spark)):
        rows = got(bpe_decode(bpe_encode(df, path), path))
        assert Counter(map(repr, rows)) == Counter(map(repr, got(bpe_round_trip(df, path))))
        slim = got(bpe_round_trip(df, path, chunks=2, words=2, with_text=False))
        assert Counter(map(repr, slim)) == Counter(repr({c: v for c, v in r.items() if c != "text"}) for r in rows)
        for r in rows:
            ids = lib.encode(r["text"] or "", add_special_tokens=False).ids
            assert r["token_ids"] == ids and r["decoded"] == lib.decode(ids, skip_special_tokens=False)


def test_token_counts_equal_library(spark, docs):
    import public_tokenizers
    import sentencepiece
    from argent.llm.token_counts import prefix_counts, token_counts, truncate_to_budget
    path = public_tokenizers.path("piece_bpe_32k.model")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (docs, real(spark)):
        for r in got(token_counts(df, path)):
            assert r["n_tokens"] == len(lib.encode(r["text"] or "")) and r["n_bytes"] == len((r["text"] or "").encode())
    for r in got(prefix_counts(docs.where("length(text) < 300"), path)):
        assert r["prefix_tokens"] == [len(lib.encode(r["text"][:i])) for i in range(1, len(r["text"]) + 1)]
    for r in got(truncate_to_budget(docs, path, 10)):
        assert r["text"] is None or (r["text"].startswith(r["truncated"]) and len(lib.encode(r["truncated"])) <= 10)


def test_main_text(spark):
    from argent.llm.html_extract import extract_main_text
    html = [None, "", "<nav>menu</nav>", "<article><h1>T</h1><p>a &amp;  b<br><p>c<div class='ad'>buy</div><script>x</p></script></article><footer>f",
            "<div class='sidebar'>x</div><div><p>hello, world. this is text</p><ul><li>one<li>two</ul></div>", "plain"]
    df = spark.createDataFrame([(i, h, "old") for i, h in enumerate(html)], "page_id long, html string, text string")
    rows = {r["page_id"]: r for r in got(extract_main_text(df))}
    assert [rows[i]["text"] for i in range(6)] == ["", "", "", "T\na & b\nc", "hello, world. this is text\none\ntwo", "plain"]
    assert all(r["n_chars"] == len(r["text"]) for r in rows.values())


BODY = "".join(f"<p>This is a sentence, with a comma and more words in it. It goes on, number {i}, for a while; then it ends.</p>" for i in range(6))
CARDS = "".join(f"<article class='card'><h3><a href='/{i}'>Teaser title {i}</a></h3><p>A short teaser of it {i}</p></article>" for i in range(5))
LINKS = "<ul><li><a href='/a'>Other page</a></li><li><a href='/b'>Third page here</a></li></ul>"


@pytest.mark.parametrize("page", [
    "<article>{}</article>", "<main>{}</main>", "<div>{}</div>", "<div>{}</div>" + CARDS, "<div>{}" + CARDS + "</div>",
    "<main>{}" + LINKS + "</main>", "<article>{}</article>" + LINKS, "<div><div>{}</div>" + LINKS + "</div>"])
def test_main_text_by_score(page):
    from argent.llm.html_extract import main_text
    want = re.findall(r"<p>(.*?)</p>", BODY)
    assert main_text(page.format("<h1>The title</h1>" + BODY)).split("\n") == ["The title", *want]


@pytest.mark.parametrize("page", [
    "<div style='overflow:hidden' class='overflow-hidden'><article>{}</article></div>", "<div class='layout has-sidebar'><article>{}</article></div>",
    "<div class='no-banner'><article>{}</article></div>", "<div class='widget'><article>{}</article></div>", "<div class='widget'>{}</div>",
    "<form action=x><div>{}</div></form>", "<article><header class='entry-header'>{}</header></article>", "<article><svg viewBox='0 0 1 1'/>{}</article>",
    "<article><math/>{}</article>", "<datalist><option>a<option>b</datalist><article>{}</article>", "<datalist><option>a<article>{}</article>",
    "<article><div><button>Press</div>{}</article>", "<article><select><option>a<option>b</select>{}</article>",
    "<article>{}<p hidden>Not shown, and long enough to count. Not shown.</p></article>"])
def test_main_text_keeps_articles_in_furniture(page):
    from argent.llm.html_extract import main_text
    want = re.findall(r"<p>(.*?)</p>", BODY)
    title = "<h1>The title</h1>"
    page = page.format(title).replace("</header>", "</header>" + BODY) if "entry-header" in page else page.format(title + BODY)
    assert main_text(page).split("\n") == ["The title", *want]


MEGA = 1 << 20


@pytest.mark.parametrize("page, kept", [
    ("<div>word " * (MEGA // 10), False), ("<a " * (MEGA // 3), True), ("<b>" * (MEGA // 3), True), ("<b>x<p>y" * (MEGA // 8), True),
    ("<a b=\"c' " * (MEGA // 9), True), ("<a" * (MEGA // 2) + " '>", True), ("<article>x" * (MEGA // 10), True),
    ("<div>" * 50_000 + "<head><body>" * 50_000, True), ("<div>" * 90_000 + "</b>" * 90_000 + "<b></div>" * 50_000, True), ("&#" + "9" * MEGA, True)])
def test_main_text_long_malformed_pages(page, kept):
    """Time is linear in the page, whatever it holds, and the article before it stays."""
    import time
    from argent.llm.html_extract import main_text
    t = time.process_time()
    text = main_text("<article>" + BODY + "</article>" + page)
    assert time.process_time() - t < 15  # 9 to 20 seconds for 64 kB before
    if kept:
        assert text.split("\n")[:6] == re.findall(r"<p>(.*?)</p>", BODY)


def test_tags_by_brute_force():
    """Tokens of the scanner and of its table against a reading letter by letter."""
    import random
    from argent.llm.html_extract import Tags

    def tokens(page, at):
        while (at := page.find("<", at)) >= 0:
            rest, end = page[at:], -1
            if rest.startswith("<!--"):
                end = page.find("-->", at + 4) + 3 if "-->" in rest[4:] else len(page)
            elif rest[1:2] in ("!", "?"):
                end = page.find(">", at) + 1 or -1
            elif re.match("</?[a-z]", rest):
                i = at + re.match("</?[a-z]", rest).end()
                while i < len(page) and page[i] not in " />":
                    i += 1
                quote = None
                while i < len(page) and end < 0:
                    c = page[i]
                    if quote:
                        quote = None if c == quote else quote
                    elif c == ">":
                        end = i + 1
                    elif c in "'\"":
                        quote = c
                    i += 1
            if end >= 0:
                yield at, end
            at = max(at + 1, end)
    rng = random.Random(5)
    for _ in range(4000):
        page = "".join(rng.choice(["<", "<a", "</a", "<!--", "-->", "<!", "<?", ">", "'", '"', " ", "x", "/"]) for _ in range(rng.randrange(30)))
        for table in (False, True):
            tags, at, found = Tags(page), 0, []
            if table:
                tags._table(0)
            while token := tags.next(at):
                found.append(token[:2])
                at = token[1]
            assert found == list(tokens(page, 0)), page


def brute_main_text(page):
    """The docstring of main_text with whole paths, element by element."""
    import math
    from argent.llm.html_extract import FURNITURE, HELD, LINKED, MARKED, PUNCTUATION, blocks
    assert "header" in FURNITURE
    chains = []
    for leaf, text, linked in blocks(page)[0]:
        chain = []
        while leaf:
            chain.insert(0, leaf)
            leaf = leaf.up
        chains.append((chain, text, linked))
    size = Counter()
    for chain, text, _ in chains:
        for e in chain:
            size[e] += len(text)
    main = ("article", "main")
    plain = not any(e.tag in main for e in size)

    def counts(e, by_tag):
        if e.holds or plain and 2 * size[e] > sum(len(t) for _, t, _ in chains) and not (by_tag and e.tag in ("nav", "footer")):
            return False
        return by_tag or not (e.inside and e.h1)
    kept = [c for c in chains if not any(e.aside and counts(e, True) for e in c[0])]
    if not kept:
        return ""
    whole = sum(len(t) for _, t, _ in kept)
    paths = {}
    for chain, text, linked in kept:
        path = tuple((e.tag, e.marked and counts(e, False)) for e in chain)
        paths.setdefault(path, []).append((len(text), len(PUNCTUATION.findall(text)), linked, len(text) * min(1, max([size[e] / whole for e in chain if e.tag in main], default=0))))
    order = list(paths)

    def smooth(x):
        y = [x[0], *x, x[-1]]
        return x if len(x) < 2 else [(y[i - 1] / 2 + y[i] + y[i + 1] / 2) / 2 for i in range(1, len(y) - 1)]
    length = {p: sum(n for n, *_ in paths[p]) for p in order}
    densities = smooth([length[p] / len(paths[p]) for p in order])
    points = smooth([sum(k for _, k, *_ in paths[p]) / len(paths[p]) for p in order])
    score, link = {}, {}
    for p, d, k in zip(order, densities, points):
        link[p] = 0 if p[-1:] == (("h1", False),) else sum(x[2] for x in paths[p]) / length[p]
        score[p] = math.log1p(d) * (1 + math.log1p(k)) * (MARKED if any(m for _, m in p) else 1) * (1 - LINKED * link[p])
    limit = sum(score[p] * length[p] for p in order) / sum(length.values()) / 2
    weight = Counter()
    for p in order:
        weight[p[:-1]] += score[p] * length[p]
    best = max(weight, key=lambda c: (weight[c], -len(c)))
    for p in order:
        if not any(m for _, m in p):
            r = 1 + sum(x[3] for x in paths[p]) / length[p]
            if best and p[:len(best)] == best and "article" not in [t for t, _ in p[len(best):]]:
                r *= HELD
            score[p] *= 1 + (r - 1) * (1 - link[p])
    good = {p for p in order if score[p] >= limit}
    return "\n".join(text for chain, text, _ in kept if tuple((e.tag, e.marked and counts(e, False)) for e in chain) in good)


def test_main_text_by_brute_force(spark):
    import random
    from argent.llm.html_extract import main_text
    pages = [r["html"] for r in spark.read.parquet(f"{SF0001}/pages.parquet").collect()]
    rng = random.Random(11)
    bits = ["<svg>", "<option>", "<span class='ad'>", "<b>", "</div>", "<div class='widget'>", '"', "<a href=x>", "<main>", "<h1>", "<head>", "<dialog>", "</article>", "<nav>"]
    for page in pages:
        tokens = re.split(r"(<[^>]*>)", page or "")
        for _ in range(4):
            assert main_text("".join(tokens)) == brute_main_text("".join(tokens))
            for _ in range(5):
                i = rng.randrange(len(tokens) + 1)
                tokens[i:i + rng.randrange(2)] = [rng.choice(bits)]
            if rng.random() < 0.5:
                tokens = [t.replace("article", "div") for t in tokens]


def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    from argent.llm.mixing import mixing_plan
    import public_tokenizers
    from tokenizers import Tokenizer
    rows = corpus_pipeline.run(spark, SF0001).collect()
    d = real(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, d = d, stage(spark, d, SF0001)
        assert set(d.columns) == set(before.columns)
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for r in d.collect():
        ids = lib.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()] += 1
    assert want == Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in rows)
    for _, stage in corpus_pipeline.STAGES:  # an empty table goes through
        assert stage(spark, real(spark).limit(0), SF0001).count() == 0


def test_empty_tables(spark, docs):
    from argent.llm.embeddings import near_vectors
    from argent.llm.lm_score import lm_scores
    from argent.llm.minhash import near_duplicates
    from argent.llm.suffix_dedup import drop_repeats
    none = docs.limit(0)
    assert near_duplicates(none).count() == drop_repeats(none).count() == 0
    assert lm_scores(none, none.select(F.col("doc_id").alias("id"))).count() == 0
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_strings_of_one_hash_are_compared():
    """Right hashes, hashes that many strings share and one hash for all give what the bytes say."""
    from argent.llm.suffix_dedup import repeated_cells
    rng = np.random.default_rng(5)
    for length, reach, m in ((6, 4, 60), (5, 3, 9000), (3, 0, 40), (6, 4, 1)):
        text = rng.integers(97, 99, (m, reach + length)).astype(np.uint8)
        text[m // 2:m // 2 + 3] = text[0]
        spot = np.flatnonzero(rng.random(m * (reach + 1)) < 0.7)
        cells = [(int(s % (reach + 1)), text[s // (reach + 1), reach - s % (reach + 1):][:length].tobytes()) for s in spot.tolist()]
        seen = Counter(cells)
        want = [seen[c] > 1 for c in cells]
        right = np.array([hash(c) for c in cells], np.int64).view(np.uint64)
        for hashes in (right, right % np.uint64(7), np.zeros(len(spot), np.uint64)):
            assert repeated_cells(text, spot, hashes, length).tolist() == want
    assert repeated_cells(text, np.zeros(0, np.int64), np.zeros(0, np.uint64), length).tolist() == []


class _Here:
    """Stands for a DataFrame of which one task is run in this process."""

    def select(self, *_):
        return self

    def mapInArrow(self, fn, _):
        return fn


def _ranges(texts, splitters, length):
    """Sorted runs of every suffix with GRAM bytes or more, by range."""
    import pyarrow as pa
    from argent.llm.suffix_dedup import GRAM, sorted_runs
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(texts),
                                        pa.array([range(len(t) - GRAM + 1) for t in texts], pa.list_(pa.int64()))], names=["_k1", "_k2", "text", "places"])
    half = len(texts) // 2
    runs = pa.Table.from_batches(list(sorted_runs(_Here(), splitters, length)(iter([batch.slice(0, half)])))
                                 + list(sorted_runs(_Here(), splitters, length)(iter([batch.slice(half)]))))
    r = runs.column("range").to_numpy()
    return [runs.filter(pa.array(r == x)) for x in np.unique(r).tolist()]


@pytest.mark.parametrize("ranges, block, cells", [(1, 1, 50), (1, 2048, 400_000), (5, 7, 300), (40, 1, 50), (400, 3, 900)])
def test_ranges_looked_through_by_blocks(monkeypatch, ranges, block, cells):
    """Blocks, slices and ranges of any size give the strings that brute force gives."""
    from argent.llm import suffix_dedup as sd
    for name, n in (("BLOCK", block), ("CELLS", cells), ("OUT_ROWS", 7), ("RUN_ROWS", 3), ("RUN", 200)):
        monkeypatch.setattr(sd, name, n)
    length, rng = 48, np.random.default_rng(3)
    word = lambda n, k: "".join(rng.choice(list("abcdefgh"[:k]), n))
    hot, warm = word(70, 3), word(60, 8)
    texts = [word(int(rng.integers(0, 20)), 8) + x + word(int(rng.integers(0, 20)), 2) for x in [hot] * 12 + [warm] * 3 + [hot[:50], hot[5:60], "é" * 40, word(80, 8), "a" * 130, "a" * 70 + "\0" * 70]]
    texts = [t for t in texts if len(t.encode()) == len(t)] + [hot, hot[:40], "\0" * 60]
    suffixes = sorted(sd.suffix(t.encode(), p, length)[0] for t in texts for p in range(len(t) - sd.GRAM + 1))
    splitters = sd.splitters_of(suffixes, ranges)
    assert splitters == sorted(set(splitters)) and len(splitters) < ranges and all(len(s) >= sd.GRAM for s in splitters)
    settled, open_, hashes = set(), [], Counter()
    for table in _ranges(texts, splitters, length):
        for b in sd.merge_range(table, splitters, length):
            assert b.num_rows <= 7
            for x in b.to_pylist():
                if x["h1"] is None:
                    settled |= {(x["_k1"], p) for p in range(x["lo"], x["hi"] - length + 1)}
                else:
                    hashes[x["h1"], x["h2"]] += 1
                    if x["open"]:
                        open_.append((x["_k1"], x["lo"], x["hi"], (x["h1"], x["h2"])))
    assert ranges > 1 or not hashes
    assert ranges < 400 or hashes
    for k, lo, hi, h in open_:
        assert hi - lo == length
        if hashes[h] > 1:
            settled.add((k, lo))
    seen = Counter(t[p:p + length] for t in texts for p in range(len(t) - length + 1))
    assert settled == {(k, p) for k, t in enumerate(texts) for p in range(len(t) - length + 1) if seen[t[p:p + length]] > 1}


def test_memory_of_a_range_is_bounded():
    """Merging a range takes far less than a hash for each string of its suffixes."""
    import tracemalloc
    from argent.llm import suffix_dedup as sd
    rng = np.random.default_rng(4)
    lines = ["".join(x) for x in rng.choice(list("abcdefghij klmnop"), (40, 400))]
    texts = [lines[i % 40][:300] + str(i) + lines[(i * 7 + 1) % 40][:300] for i in range(36)]
    table, = _ranges(texts, [], 200)
    tracemalloc.start()
    found = 0
    for b in sd.merge_range(table, [], 200):
        found += b.num_rows if hasattr(b, "num_rows") else 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    n = sum(len(c) // 4 for c in table.column("count").to_pylist())
    assert n > 15_000 and found
    assert peak < 80 << 20


def test_range_ends_keep_small_groups_whole():
    """Suffixes that share their first GRAM bytes are parted only when a range ends among them twice; a hot key ends one range."""
    from argent.llm.suffix_dedup import GRAM, splitters_of
    group = [bytes([65 + i // 5]) * GRAM + bytes([65 + i % 5]) * 8 for i in range(100)]
    for ends in range(1, 15):
        assert all(len(s) == GRAM for s in splitters_of(group, ends))
    assert splitters_of([b"b" * 40] * 90 + group, 10).count(b"b" * GRAM) <= 1
    hot = [b"x" * GRAM + bytes([97 + i % 26]) * 8 for i in range(260)]
    got = splitters_of(sorted(group + hot), 60)
    assert got == sorted(set(got)) and sum(s.startswith(b"x" * GRAM) for s in got) > 10
    assert splitters_of([], 9) == splitters_of(group, 1) == []
