"""Operators that compare or count over the corpus: 2, 4, 5, 6, 9, and the pipeline."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from outcomelake.llm import embedding_dedup, html_text, minhash_dedup, mixing, suffix_dedup
from outcomelake.llm.components import components
from llm_fixtures import make_docs, no_docs, odd_docs, prose, row  # noqa: F401


def find_components(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = n = parent[parent[n]]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (900, 900)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == find_components({n for e in edges for n in e}, edges)
    assert components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def copies(rng):
    """Groups of near copies around the threshold, with a passage that many share."""
    passage, texts = prose(rng, 50), []
    for _ in range(12):
        words = prose(rng, rng.choice([4, 30, 120])).split() + passage.split() * rng.randrange(2)
        for _ in range(rng.choice([1, 2, 9])):
            other = list(words)
            for _ in range(rng.randrange(4)):
                other[rng.randrange(len(other))] = prose(rng, 1)
            texts.append(" ".join(other))
    return texts + [passage] * 40 + [passage + " " + prose(rng, rng.randint(0, 6)) for _ in range(60)]


@pytest.mark.parametrize("width,percent,short", [(3, 85, 16), (5, 80, 1), (3, 85, 1)])
def test_near_duplicates(make_docs, monkeypatch, width, percent, short):
    monkeypatch.setattr(minhash_dedup, "SHORT", short)  # 1: every list goes by blocks
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "COLUMNS", 64)
    texts = copies(random.Random(width))
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    edges = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = find_components(range(len(texts)), edges)
    for r in minhash_dedup.near_duplicates(make_docs(list(enumerate(texts))), width, percent).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("seed", [237, 733, 759])
def test_near_duplicates_of_texts_that_are_mostly_a_shared_passage(make_docs, seed):
    words = lambda rng, n: " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))
    passage, rng = words(random.Random(12), 584), random.Random(seed)
    text = f"{passage} {words(rng, 220)}"
    longer = f"{text} {words(rng, 200)}"  # 800 of 1000 shingles, 580 of them the passage's
    docs = [(k, f"{passage} {words(rng, 300)}") for k in range(30)] + [(100, text), (101, longer)]
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(make_docs(docs), 5, 80).collect()}
    assert got == {k: k for k in range(30)} | {100: 100, 101: 100}


def test_near_duplicates_with_text_ids(spark):
    passage = prose(random.Random(3), 60)
    texts = [f"{passage} {prose(random.Random(k % 20), 12)}" for k in range(60)]  # twenty groups of three, all in long lists
    docs = spark.createDataFrame([(f"d{k:02d}", t + f" end{k}") for k, t in enumerate(texts)], "doc_id string, text string")
    sets = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} for w in ((t + f" end{k}").lower().split() for k, t in enumerate(texts))]
    edges = [(i, j) for i in range(60) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    want = find_components(range(60), edges)
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs, 3, 90).collect()}
    assert got == {f"d{k:02d}": f"d{want[k]:02d}" for k in range(60)} and len(set(got.values())) == 20


def test_texts_that_share_a_passage_but_little_else_are_not_compared_in_pairs(make_docs, monkeypatch):
    words = lambda rng, n: " ".join(f"w{rng.randrange(10 ** 9)}" for _ in range(n))
    rng, compared = random.Random(7), []
    passage = words(rng, 130)
    texts = [f"{passage} {words(rng, 70)}" for _ in range(200)]  # 65 % alike, each in lists of about 200
    texts += [f"{t} again" for t in texts[:20]]
    blocks = minhash_dedup._family_blocks
    monkeypatch.setattr(minhash_dedup, "FIRST", 0)  # only the second round ties the copies
    monkeypatch.setattr(minhash_dedup, "_family_blocks", lambda rows: compared.append(rows.count()) or blocks(rows))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(make_docs(list(enumerate(texts))), 3, 85).collect()}
    assert got == {k: k % 200 for k in range(220)} and compared == [0]


def test_blocks_of_one_component_are_not_compared(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    members = [(k, 7, 50, [1, 2, 3], 11) for k in range(40)] + [(100, 100, 50, [1, 2, 4], 11)]
    placed = spark.createDataFrame(members, "rep long, comp long, n long, sketch array<long>, key long")
    blocks = minhash_dedup._family_blocks(placed.drop("sketch"))
    near, _, _ = minhash_dedup._near_members(placed.select("rep", "key"), blocks, placed.drop("key"), 80)
    pairs = {(r.x, r.y) for r in near.collect()}
    assert len(pairs) == 10 and {b for _, b in pairs} == {10} and {r.rep for r in near.collect()} == {*range(40), 100}


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = minhash_dedup.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].n_shingles == 0 and by[1][0].kept and by[2][0].kept and by[3][0].kept
    assert {r.component_id for k in (4, 9) for r in by[k]} == {4}
    assert {(r.component_id, r.kept) for r in by[5]} == {(4, False), (5, True)}
    assert all(r.component_id is None and r.kept for r in by[None])
    kept = minhash_dedup.deduplicated(odd_docs)
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, None, 1, 2, 3, 4, 5, 6, 7, 8, 10]) and kept.columns == odd_docs.columns
    assert minhash_dedup.near_duplicates(no_docs).collect() == []


def test_mixing(spark, make_docs, odd_docs, no_docs):
    rng = random.Random(6)
    docs = make_docs([row(i, "t", source=rng.choice(["a"] * 8 + ["b"] * 2)) for i in range(6000)])
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.5)], "source string, weight double")
    out = mixing.mix_sources(docs, weights)
    n = Counter(r.source for r in out.collect())
    assert abs(n["a"] - 3000) < 250 and abs(n["b"] - 3000) < 250
    assert sorted(map(str, out.collect())) == sorted(map(str, mixing.mix_sources(docs, weights).collect()))
    times = Counter(r.doc_id for r in mixing.mix_sources(docs, weights, total=240_000).collect())
    many = [times[r.doc_id] for r in docs.where("source = 'b'").collect()]
    assert abs(np.mean(many) / (120_000 / len(many)) - 1) < 0.01 and abs(np.var(many) / np.mean(many) - 1) < 0.15
    only = mixing.mix_sources(docs, weights.where("source = 'a'"))
    assert {r.source for r in only.collect()} == {"a"}
    odd = mixing.mix_sources(odd_docs.withColumn("COPY_NO", F.lit("x")), total=2000)
    assert [c for c in odd.columns if c.lower() == "copy_no"] == ["copy_no"] and abs(odd.count() - 2000) < 700
    assert None in {r.source for r in odd.collect()}
    assert mixing.mix_sources(no_docs).collect() == []


PAGES = "page_id bigint, url string, html string"


def test_html_blocks():
    page = (
        '<body class="with-sidebar"><header>Site</header><div class="cookie-notice">ok?</div><nav><a>m</a></nav>'
        "<main><p>lead</p><article><header><h1>T &amp; t&nbsp;x</h1></header>a<b>b</b>\n c<br>d<p>e<ul><li>f<li>g</ul>"
        '<script>var a="</p>"</script><!-- x --><div class=ad>ad</div><form>mail</form><p hidden>no</p>'
        '<section class="comments-area"><article>me too</article></section></article></main><footer>f</footer>&am')
    assert html_text.main_text(html_text.lines(page), set()) == "T & t x\nab c d\ne\nf\ng"
    assert html_text.main_text(html_text.lines("<main>x<p>y</main><p>z"), set()) == "x\ny"
    assert html_text.main_text(html_text.lines("a < b <unclosed"), set()) == "a < b"
    assert html_text.main_text(html_text.lines("<b>" * 3000 + "x"), set()) == "x"


@pytest.mark.parametrize("end", ["", "</head>", "</head><body>", "<body class=promo>"])
def test_html_head_without_end(end):
    page = f'<!doctype html><html><head class="header"><meta charset=utf-8><title>T</title><style>p {{}}</style><script>"</p>"</script>{end}<p>text</p><div>more'
    assert html_text.main_text(html_text.lines(page), set()) == "text\nmore"


def test_common_lines():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found, rest = html_text.common_lines(a, b), iter(b)
        assert len(found) == table[-1][-1] and all(a[k] in rest for k in found)


def test_pages_lose_what_their_neighbours_share(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BLOCK", 4)  # neighbours in other blocks count
    page = lambda k: f"<div>Welcome to us</div><div>Own text of page {k}</div><div>All rights, whoever reads</div>"
    rows = [(k, f"http://h{k % 2}.org/a/{k:03d}", page(k)) for k in range(41)] + [(99, "http://alone.org/x", page(99)), (None, None, None), (100, "", "")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows + rows[:1], PAGES).withColumn("Text", F.lit(1))).collect()}
    assert all(got[k].text == f"Own text of page {k}" for k in range(41))
    assert got[99].text.count("\n") == 2 and got[None].text == "" and got[100].text == ""
    assert html_text.extract(spark.createDataFrame([], PAGES)).collect() == []


def test_copies_under_neighbouring_urls_keep_their_text(spark):
    page = lambda *own: "".join(f"<div>{t}</div>" for t in ("Welcome to us", *own, "All rights, whoever reads"))
    story = ("A heading", "Short words of a story", "and a few more of them at its end", "told by nobody to anyone at all")
    rows = [(1, "http://h.org/a/1", page("Other things")), (2, "http://h.org/a/2", page(*story)), (3, "http://h.org/a/3", page(*story)),
            (4, "http://copies.org/1", page(*story)), (5, "http://copies.org/2", page(*story))]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[1] == "Other things" and got[2] == got[3] == "\n".join(story)
    assert got[4] == got[5] == "\n".join(("Welcome to us", *story, "All rights, whoever reads"))


def test_articles_lose_what_all_their_neighbours_share(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BLOCK", 5)  # voters in other blocks count
    own = lambda k: [f"Own text number {k} of page {k}, said once", "A sentence that every other article has"][:1 + k % 2]

    def page(k, *more):
        body = "".join(f"<p>{t}</p>" for t in (*own(k), *more))
        return f"<nav>menu</nav><article><h1>Story {k}</h1><p>Share this story</p><h2>Results</h2>{body}<h3>More</h3><p>Write to our editors</p></article>"

    rows = [(k, f"http://h.org/{k:03d}", page(k)) for k in range(30)]
    rows += [(100 + k, f"http://few.org/{k}", page(k)) for k in range(5)]  # too few to tell
    # Half of them are short copies of the others, which differ by a word: these are one voice.
    long = lambda k: [f"Copy {k}", "The same long text " * 9][:2 * (k < 12)]
    rows += [(200 + k, f"http://copies.org/{k:03d}", page(7, *long(k))) for k in range(24)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(30):
        assert got[k] == "\n".join((f"Story {k}", "Results", *own(k)))
    whole = lambda k, *more: "\n".join((f"Story {k}", "Share this story", "Results", *own(k), *more, "More", "Write to our editors"))
    assert all(got[100 + k] == whole(k) for k in range(5))
    assert all(got[200 + k] == whole(7, *[t.strip() for t in long(k)]) for k in range(24))
    bare = html_text.lines("<article><h1>Same</h1><p>Same words</p></article>")
    assert html_text.main_text(bare, {0, 1}) == "Same\nSame words"


def test_given_articles_are_kept_whole(spark):
    """Every given page holds a heading and one of the given documents; no line of those may go."""
    rows = html_text.extract(spark.read.parquet("/root/testdata/sf0.01/pages.parquet")).select("text").collect()
    tidy = lambda text: "\n".join(x for x in (" ".join(line.split()) for line in text.split("\n")) if x)
    documents = {tidy(r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect() if r.text}
    assert rows and all(r.text.partition("\n")[2] in documents for r in rows)


VECTORS = "vec_id bigint, embedding array<float>, label int"


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "INTERVAL", 40)
    monkeypatch.setattr(embedding_dedup, "SMALL", 8)
    rng = np.random.default_rng(1)
    rows = []
    for k in range(40):
        centre = rng.normal(size=12)
        for _ in range(rng.integers(1, 12)):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + rng.normal(size=12) * rng.choice([0.1, 0.25])], int(k % 3)))
    rows += [(1000 + k, rows[0][1], rows[0][2]) for k in range(50)] + [(2000, rows[0][1], 2), (2001, rows[0][1], None)]
    rows += [(3000, None, 0), (3001, [], 0), (3002, [0.0] * 12, 0), (3003, [float("nan")] * 12, 0), (3004, [float("inf")] + [1.0] * 11, 0),
             (3005, [1.0, None] + [1.0] * 10, 0), (3006, rows[0][1][:5], rows[0][2]), (None, rows[0][1], rows[0][2])]
    sound = [(i, np.array(v), c) for i, v, c in rows if i is not None and i < 3000 and c is not None] + [(3006, np.array(rows[0][1][:5]), rows[0][2])]
    edges = [
        (i, j) for a, (i, v, c) in enumerate(sound) for j, w, d in sound[:a]
        if c == d and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.93]
    degree, want = Counter(n for e in edges for n in e), find_components([r[0] for r in rows if r[0] is not None], edges)
    found = embedding_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == len(rows) and len(edges) > 1000
    for r in found:
        if r.vec_id is None:
            assert (r.n_links, r.component_id, r.kept) == (0, None, True)
        else:
            assert (r.n_links, r.component_id, r.kept) == (degree[r.vec_id], want[r.vec_id], want[r.vec_id] == r.vec_id)
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], VECTORS)).collect() == []


def brute_repeats(texts, length):
    seen = Counter(t[s:s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = set()
        for s in range(len(t) - length + 1):
            if seen[t[s:s + length]] > 1:
                gone.update(range(s, s + length))
        runs = sum(1 for k in gone if k - 1 not in gone)
        out.append((len(t), len(gone), runs, hashlib.sha256(bytes(b for k, b in enumerate(t) if k not in gone)).hexdigest()))
    return out


@pytest.mark.parametrize("length,part", [(200, 1 << 21), (50, 300), (7, 1 << 21)])
def test_repeated_bytes(make_docs, monkeypatch, length, part):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rng = random.Random(length)
    passages = [prose(rng, 60), prose(rng, 40), "é漢" * 70, "z" * 300]
    texts = [" ".join(rng.choice([prose(rng, 30), rng.choice(passages), rng.choice(passages)[3:]]) for _ in range(rng.randint(1, 4))) for _ in range(50)]
    texts += [texts[0], texts[0], "", "ab", passages[0], *[texts[1]] * 20, *["ab" * 200] * 9]
    want = brute_repeats([t.encode() for t in texts], length)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.digests(make_docs(list(enumerate(texts))), length).collect()}
    assert [found[k] for k in range(len(texts))] == want


def test_repeated_bytes_of_odd_rows(odd_docs, no_docs):
    rows = suffix_dedup.repeats(odd_docs, 100, keep_text=True).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (4, 10):
            assert bytes(r.kept_bytes) == b"" and len(r.spans) == 1
        assert hashlib.sha256(bytes(r.kept_bytes)).hexdigest() == r.kept_sha256
    assert suffix_dedup.digests(no_docs).collect() == []


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    good = [prose(rng, 80) for _ in range(120)]
    texts = good + [g.replace(g.split()[40], "changed", 1) for g in good[:10]] + [" ".join(w.upper() + "!!" for w in prose(rng, 60).split()) for _ in range(80)]
    texts += [None, "", "password: Zk4vQ9mWx2Lp " + prose(rng, 60)]
    rows = [row(k, t, source=f"s{k % 3}") for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 130), 0) for k in range(0, 210)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, sizes = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(path := f"{tmp_path}/{name}")
        docs = spark.read.parquet(path)
        sizes.append(docs)
    assert all(d.columns == columns for d in sizes[:-1])
    kept = {r.doc_id for r in sizes[0].collect()}
    assert len(kept & set(range(130))) >= 125 and not kept & {210, 211} and len(kept & set(range(130, 210))) <= 4
    alone = {r.doc_id for r in sizes[1].collect()}
    assert not alone & set(range(120, 130)) and set(range(120)) & kept <= alone
    assert {r.doc_id for r in sizes[2].collect()} == alone
    assert 212 not in alone or "Zk4vQ9mWx2Lp" not in [r.text for r in sizes[2].collect() if r.doc_id == 212][0]
    assert {r.doc_id for r in sizes[3].collect()} <= alone and sizes[4].count() == sizes[3].count()


@pytest.mark.parametrize("name", ["op4_mixing", "op6_embedding_dedup"])
def test_queries_with_sql(spark, name):
    from outcomelake.llm.queries import llm_oracles, llm_queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(llm_oracles()[name])
    got = llm_queries()[name](spark, sf).select(*want.columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_every_query_runs(spark):
    from outcomelake.llm.queries import llm_queries

    tables = {"op5": "pages", "op6": "embeddings"}
    for name, query in llm_queries().items():
        table = tables.get(name.split("_")[0], "documents")
        rows = query(spark, "/root/testdata/sf0.001").count()
        assert rows == spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").count() or name.startswith("op4")
