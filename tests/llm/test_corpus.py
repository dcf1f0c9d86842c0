"""Each corpus operator against brute force on small tables with nulls, empties, long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from walrill.llm import ann, common, decontam, graph, html_extract, mixing, neardup, pii, queries, sharding, substring, token_store, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().split()


def docs_of(spark, rows, source=None):
    return spark.createDataFrame([(i, t, "en", source(k) if source else "s", None if t is None else len(t)) for k, (i, t) in enumerate(rows)], DOCS).repartition(3)


def corpus(seed=1):
    """Texts with exact and near copies, shared passages, nulls, blanks, a long text, rows that share an id or have none."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(120)
    rows = [(i, text(r.randint(1, 90))) for i in range(40)]
    rows += [(100 + i, base) for i in range(4)] + [(200 + i, " ".join(w if r.random() > 0.004 * i else "zz" for w in base.split())) for i in range(8)]
    rows += [(300 + i, f"{text(25)} {passage}\n{text(10 * i)}") for i in range(4)] + [(310, f"{passage} {passage}")]
    rows += [(400, None), (401, ""), (402, " \t\n"), (403, "A b c"), (404, "a B C"), (405, " ".join(["x"] * 90)), (406, text(9000)), (7, text(30)), (7, text(30)), (None, text(40)), (None, base), (100, base), (407, "one"), (408, "É é   nbsp x")]
    return rows


def test_word_hashes_depend_on_words_alone():
    texts = [b"a b c d e f", None, b"", b"x", b"  Hello\tWORLD hello ", ("wö rd " * 200_000).encode(), b"a b c d e f"]
    h, at = common.word_hashes(texts)
    assert np.diff(at).tolist() == [6, 0, 0, 1, 3, 400_000, 6] and (h[: at[1]] == h[at[6] :]).all()
    assert common.windows(h[:6], 5)[1] == common.windows(common.word_hashes([b"b c d e f"])[0], 5)[0]
    assert common.word_hashes([b"HeLLo"], True)[0] == common.word_hashes([b"hello"])[0] != common.word_hashes([b"HeLLo"])[0]


# --- 1 ---

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><nav>menu, a, b</nav></header><div id=cookie-notice>We use, cookies, lots.</div>
<main><article class=post><header><h1>Title &amp; more</h1><p class=byline>By X</p></header><p>First, para with <a href="x>y">link</a>
 and a&nbsp;b.</p><div class="ad-box">Buy, now</div><ul><li>one<li>two</ul><p>Second<br>line.<script>var x = "</p>";</script><form>name <input></form>
<section><h2>Sec</h2><p>short</p></section></article><section class="comments"><article class="comment"><p>Great, great, great, great, great, article</p></article>
</section></main><aside>side, bar</aside><footer>foot, er</footer></body></html>"""


def test_main_text(spark):
    assert html_extract.main_text(PAGE).split("\n\n") == ["Title & more", "First, para with link and a b.", "one", "two", "Second line.", "Sec", "short"]
    divs = "<div id=content><div class=text><p>" + "Hello, world, text. " * 10 + "</p><p>More, text.</p></div><div class=related><ul><li><a href=x>r</a></ul></div></div><div class=sidebar><p>" + "side, text, " * 30 + "</p></div>"
    assert html_extract.main_text(divs) == ("Hello, world, text. " * 10).strip() + "\n\nMore, text."
    assert [html_extract.main_text(x) for x in (None, "", "a < b &lt;", "<p>a<p>b", "<a " * 30_000 + '"')] == ["", "", "a < b <", "a\n\nb", ""]
    rows = [(1, "u", PAGE), (1, None, None), (None, "v", "<p>x</p>"), (2, "w", "<p>" + "long, " * 50_000 + "</p>")]
    got = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("other"))).collect()
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got) == [(0, 1), (1, 0), (1, len(html_extract.main_text(PAGE))), (2, 299_999)]
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def brute_tree(html):
    """The tree as nested lists, every look-up a walk up the tree; for markup of plain tags and text."""
    root = {"tag": "html", "up": None, "kids": []}
    now = root

    def up(node, stop):
        while node is not root and not stop(node["tag"]):
            node = node["up"]
        return node

    for m in re.finditer(r"<(/?)([a-z0-9]+)>|([^<]+)", html):
        closing, tag, text = m.groups()
        if text:
            now["kids"].append(text)
        elif closing:
            found = up(now, lambda t: t == tag or tag not in html_extract.BLOCKS and t in ("td", "th", "table"))
            now = found["up"] if found is not root and found["tag"] == tag else now
        else:
            if tag in html_extract.ENDS_P:
                found = up(now, lambda t: t in ("p", "td", "th", "table", "button", "li", "article", "section", "div", "blockquote"))
                now = found["up"] if found["tag"] == "p" else now
            if tag in html_extract.ENDS:
                likes, holds = html_extract.ENDS[tag]
                node, last = now, None
                while node is not root and node["tag"] not in holds:
                    last = node if node["tag"] in likes else last
                    node = node["up"]
                now = last["up"] if last else now
            now["kids"].append({"tag": tag, "up": now, "kids": []})
            now = now["kids"][-1]
    return root


def plain(node):
    """A tree of either kind as (tag, items), neighbouring texts joined."""
    tag, kids = (node["tag"], node["kids"]) if isinstance(node, dict) else (node.tag, node.items)
    return tag, [x if isinstance(x, str) else plain(x) for x in kids]


def test_tree_and_points_against_brute_force(spark):
    r = random.Random(6)
    tags = ["p", "div", "b", "span", "li", "ul", "td", "tr", "table", "section", "h2", "dd", "dl", "blockquote", "article", "th"]
    for _ in range(400):
        html = "".join(r.choice([f"<{t}>", f"<{t}>", f"</{t}>", "a, b", "word word word word word, "]) for t in r.choices(tags, k=r.randint(1, 60)))
        assert plain(html_extract.parse(html)) == plain(brute_tree(html)), html
    pages = [x["html"] for x in spark.read.parquet(f"{SF}/pages.parquet").select("html").limit(60).collect() if x["html"]]
    for html in [PAGE, *pages]:
        order = html_extract._measure(html_extract.parse(html))
        gives = {"div", "section", "article", "main", "body"}
        kids = lambda n: [x for x in n.items if isinstance(x, html_extract.Node) and not x.dropped]
        own = lambda n: [x for x in n.items if isinstance(x, str)]
        length = lambda n: sum(len(x.strip()) for x in own(n)) + sum(map(length, kids(n)))
        linked = lambda n: length(n) if n.tag == "a" else sum(map(linked, kids(n)))
        commas = lambda n: "".join(own(n)).count(",") + sum(map(commas, kids(n)))
        points = dict.fromkeys(map(id, order), 0.0)
        for n in order:
            direct = "".join(own(n))
            if not (n.tag in ("p", "pre", "blockquote", "td", "li", "dd") or n.tag in gives and len(direct.split()) >= 5) or length(n) < 2 or n.parent is None:
                continue
            given = (1 + (direct.count(",") if n.tag in gives else commas(n)) + min(length(n) / 100, 3)) * (1 - linked(n) / length(n))
            chain, at = [], n if n.tag in gives else n.parent
            while at is not None:
                chain.append(at)
                at = at.parent
            for share, holder in zip((1, 1 / 2, 1 / 3), chain, strict=False):
                points[id(holder)] += given * share
        assert all(n.points == pytest.approx(points[id(n)]) and n.length == length(n) and n.linked == linked(n) for n in order)


def test_bad_markup_takes_linear_time():
    n = 60_000
    bad = ["<blockquote>, " * n, "<div>" * n + "</span>" * n, "<b><table><td>" + "<div>" * n + "</b>" * n, "<b>" * n + "<ul>" * n, "<a " + "'" * 10 * n + ">", "<li><b>" * n, "<a x='" * n, "<p class='a " + "b " * n + "'>x", "&#" + "9" * n + "; &#" + "0" * n + "65;", "<!--" * n, "<script>" * n, "<td><tr>" * n, "&" * 10 * n]
    for html in bad:
        begun = time.process_time()
        html_extract.main_text(html)
        assert time.process_time() - begun < 15, html[:30]
    assert html_extract.main_text("<p>&#" + "0" * 9_000 + "65;&#" + "7" * 9_000 + ";&#66;") == "A\ufffdB"


# --- 2 ---


def test_token_files_round_trip(spark):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("word_bpe_49k.json")
    rows = [*corpus(), (900, "Hello, WORLD's it's. <|endoftext|> <|ENDOFTEXT|>x. a.. b… É. ́x İ. 中文。 4,5! ?? don't."), (901, "y" * 3_000)]
    docs = docs_of(spark, rows)
    store = token_store.write_tokens(docs, path)
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in token_store.read_digests(spark, store).collect()))
    whole, start = tokenizers.Tokenizer.from_file(path), 0
    coded = {t: [*whole.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows}
    want = Counter((i, len(coded[t]), zlib.crc32(np.array(coded[t], "<u4").tobytes())) for i, t in rows)
    assert Counter((i, n, c) for _, i, n, c in got) == want
    for s, _, n, _ in got:
        assert s == start
        start += n
    ids = [i for _, i, _, _ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert token_store.read_digests(spark, token_store.write_tokens(docs.limit(0), path)).collect() == []
    small = token_store.write_tokens(docs.withColumn("tie", F.lit("mine")).withColumn("tokens", F.lit(0)), path, shard_tokens=500)
    assert len(small.shards) > 20 and sorted((x["start"], x["n_tokens"], x["ids_crc32"]) for x in token_store.read_digests(spark, small).collect()) == sorted((a, n, c) for a, _, n, c in got)


def test_other_tokenizers_encode_whole_texts(spark):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    rows = [(1, "Hello  World\n\nx"), (2, None), (3, "it's <|endoftext|> é"), (4, "")]
    whole = tokenizers.Tokenizer.from_file(path)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_store.read_digests(spark, token_store.write_tokens(docs_of(spark, rows), path, end_id=50_256)).collect()}
    for i, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 50_256]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert token_store.of_words(public.path("word_bpe_49k.json")) and not token_store.of_words(path)


# --- 3 ---


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i))) for i, (d, _) in enumerate(rows)]


def test_near_duplicates(spark):
    rows = corpus()
    got = neardup.near_duplicates(docs_of(spark, rows)).collect()
    want = Counter((d, n, c, d == c) for d, n, c in brute_components(rows))
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got) == want
    assert neardup.near_duplicates(docs_of(spark, rows).limit(0)).collect() == []


def test_sketch_fills_and_estimates():
    r = np.random.default_rng(3)
    a = r.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [a[:800], a[200:], a[:1]]
    grid = neardup.sketches(np.concatenate([np.sort(x) for x in sets]), np.array([0, 800, 1600, 1601]), 168)
    assert (grid != np.uint64(2**64 - 1)).all() and abs((grid[0] == grid[1]).mean() - 0.6) < 0.15


def test_large_cluster_goes_through_chunks(spark, monkeypatch):
    r = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [(i, " ".join(w if r.random() > 0.02 else f"e{i}" for w in base)) for i in range(60)]
    monkeypatch.setattr(neardup, "CHUNK_SETS", 8)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs_of(spark, rows)).collect()}
    assert got == {d: c for d, _, c in brute_components(rows)} and len(set(got.values())) > 1


def test_clusters_of_groups_and_loose_sets(spark, monkeypatch):
    r = random.Random(15)
    words_ = [f"b{i}" for i in range(120)]
    # Two dense groups that differ by a fifth of their words, sets between them that belong to neither, and a chain of edits.
    other = [*words_[:96], *(f"c{i}" for i in range(24))]
    edit = lambda base, p, k: " ".join(w if r.random() > p else f"e{k}x{i}" for i, w in enumerate(base))
    rows = [(k, edit(words_, 0.004, k)) for k in range(30)] + [(100 + k, edit(other, 0.004, k + 100)) for k in range(30)] + [(200 + k, edit(words_, 0.05, k + 200)) for k in range(25)]
    chain = list(words_)
    for k in range(25):
        chain[3 * k] = f"z{k}"
        rows.append((300 + k, " ".join(chain)))
    want = {d: c for d, _, c in brute_components(rows)}
    for sets in (8, 256):
        monkeypatch.setattr(neardup, "CHUNK_SETS", sets)
        assert {x["doc_id"]: x["component_id"] for x in neardup.near_duplicates(docs_of(spark, rows)).collect()} == want and len(set(want.values())) > 3


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (5, 5)], "a long, b long")
    assert {r["node"]: r["component"] for r in graph.components(edges).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}
    assert graph.components(edges.limit(0)).collect() == []


# --- 4 ---


def test_mixture(spark):
    rows = corpus() * 3
    source = lambda k: [None, "a", "b", "c", "d", "é"][k % 6 if k % 3 else 1]
    docs = docs_of(spark, rows, source)
    got = mixing.mixture(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in rows)
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in rows)
    by = {}
    for r in got:
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-6
        by.setdefault((r["source_size"], r["target"]), []).append(r)
    assert sum(t for _, t in by) == pytest.approx(1.5 * total)
    for (_, target), own in by.items():
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own) + 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mixture(docs.repartition(5)).collect()))
    assert mixing.mixture(docs.limit(0)).collect() == []
    clash = docs.withColumnsRenamed({"n_chars": "size"}).withColumn("copies", F.lit("mine"))
    assert mixing.with_copies(clash).columns == [*clash.columns, "_size", "source_size", "target", "_copies"]
    mixed = mixing.mixed(clash)
    assert mixed.columns == clash.columns and sum(len(words(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in got)


def test_targets_share_what_full_sources_leave(spark):
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame([("a", 10), ("b", 100), ("c", 1000), (None, 50)], "source string, source_size long")).collect()}
    # 1740 words: a, b and null stop at twice their size, c takes the rest.
    assert got == {"a": 20.0, "b": 200.0, None: 100.0, "c": 1420.0}


# --- 5 ---


def brute_nearest(rows, k=5, every=50):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)]
    out = {}
    for q, x in good:
        if q % every == 0 and q not in out:
            s = sorted((-round(float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), 12), i) for i, y in good if i != q)
            out[q] = [(i, -n) for n, i in s[:k]]
    return out


def test_nearest(spark):
    r = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=16)]) for i in range(700)] + [(1000 + i, [1.0] * 16) for i in range(20)] + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [None, *[1.0] * 15]), (None, [1.0] * 16)]
    got = {}
    for x in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit(1))).orderBy("query_id", "rank").collect():
        got.setdefault(x["query_id"], []).append((x["vec_id"], x["score"]))
    want = brute_nearest(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits / (5 * len(want)) >= 0.95
    exact = {(x["query_id"], x["rank"]): x["vec_id"] for x in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), exact=True).collect()}
    assert exact == {(q, n + 1): i for q, v in want.items() for n, (i, _) in enumerate(v)}
    assert [i for i, _ in got[1000]] == [1001, 1002, 1003, 1004, 1005] and got[1000][0][1] == pytest.approx(1)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(x["rank"], x["vec_id"]) for x in ann.nearest(few).orderBy("rank").collect()] == [(1, 2), (2, 1)]
    assert ann.nearest(few.limit(0)).collect() == []


def test_nearest_of_rows_that_share_an_id(spark):
    rows = [(0, [1.0, 0.0, 0.0]), (7, [1.0, 0.1, 0.0]), (7, [0.0, 1.0, 0.1]), (50, [0.0, 1.0, 0.0]), (50, [0.0, 0.0, 1.0]), (8, [0.1, 0.0, 1.0])]
    got = {}
    for x in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=1).collect():
        got.setdefault(x["query_id"], []).append((x["vec_id"], round(x["score"], 3)))
    assert {q: sorted(v) for q, v in got.items()} == {0: [(7, 0.995)], 50: [(7, 0.995), (8, 0.995)]}


@pytest.mark.parametrize("sample_rows, leaf", [(256, 64), (16, 32)])
def test_graph_of_leaves_that_the_sample_cannot_carry(spark, sample_rows, leaf):
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(900, 12)), np.repeat(r.normal(size=(1, 12)), 150, axis=0) + 1e-4 * r.normal(size=(150, 12))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    units = spark.createDataFrame([(i, v.tobytes()) for i, v in enumerate(x)], "node long, unit binary")
    placed = ann._placed(units.mapInArrow(ann._coarse, "node long, unit binary"), [ann.Tree(x[:16], 0, 0)], 40, leaf)
    assert max(row["count"] for row in placed.groupBy("tree", "leaf").count().collect()) <= 2 * leaf and placed.count() == 2 * len(x)
    edges = ann.build_graph(units, 16, sample_rows=sample_rows, leaf=leaf)
    found = ann.greedy_search(units.where("node % 50 = 0").select(F.col("node").alias("query"), "unit", F.col("node").alias("start")), edges, units, beam=48)
    whole = ann.exact_search(units.where("node % 50 = 0").select(F.col("node").alias("query"), "unit"), units, beam=48)
    best = [{}, {}]
    for held, df in zip(best, (found, whole), strict=True):
        for row in sorted(df.collect(), key=lambda row: (-round(row["score"], 12), row["node"])):
            if row["query"] != row["node"]:
                held.setdefault(row["query"], []).append(row["node"])
    s = x @ x.T
    assert all(own[:5] == [i for i in sorted(range(len(x)), key=lambda i: (-round(float(s[q, i]), 12), i)) if i != q][:5] for q, own in best[1].items())
    early = [q for q in best[1] if q < 900]
    assert np.mean([len({*best[0][q][:5]} & {*best[1][q][:5]}) / 5 for q in early]) >= 0.9


# --- 6 ---

DISGUISED = {"1d10t": "idiot", "i d i o t": "idiot", "st*pid": "stupid", "stuuuuupid": "stupid", "w0rthl3ss": "worthless", "p@thetic": "pathetic", "m.o.r.o.n": "moron", "cl0wn": "clown", "tr4sh!!": "trash", "$tup1d": "stupid"}


def test_restoration(spark):
    model = toxicity.language_model(spark.read.parquet(f"{SF}/documents.parquet"))
    assert model.shape == (28, 28, 28) and np.allclose(np.exp(model).sum(axis=-1), 1)
    restorer = toxicity.Restorer(model)
    for disguised, plain in DISGUISED.items():
        assert plain in restorer.words(f"so {disguised} it"), disguised


def test_restoration_against_all_paths():
    r, model = random.Random(3), np.log(np.random.default_rng(3).dirichlet(np.ones(28), (28, 28)))

    def score(path):
        total, u, v, out = 0.0, 0, 0, ""
        for x, p in path:
            total += p
            if x:
                s = toxicity._symbol(x)
                if s == 0 and v == 0:
                    return None
                total, u, v, out = total + model[u, v, s], v, s, out + x
        return total + (model[u, v, 0] if v else 0.0), out

    for _ in range(300):
        spot = "".join(r.choice("ab1*. o0zé$") * r.choice([1, 1, 1, 3]) for _ in range(r.randint(1, 3)))
        every = [x for path in itertools.product(*toxicity.lattice(spot)) if (x := score(path)) is not None]
        if every:
            best = max(every)[0]
            assert toxicity.restore(spot, model) in {out for total, out in every if total > best - 1e-9}, spot


def test_long_tokens_take_linear_time():
    restorer = toxicity.Restorer(np.log(np.full((28, 28, 28), 1 / 28)))
    for text in ["1" * 1_000_000, "中文字" * 110_000, "中文字，" * 80_000, "a" + "1" * 1_000_000 + "b", "@" * 500_000, "a" * 300_000, "a1" * 100_000, "x " * 100_000]:
        begun = time.process_time()
        restorer.words(text)
        assert time.process_time() - begun < 15, text[:10]
    assert [toxicity.spots(t) for t in ("tr4sh!!", "!!a1b", "(idiot", "x" + "7" * 40 + "y", "stuuupid", "plain", "42")] == [["tr4sh"], ["a1b"], ["(idiot"], [], ["stuuupid"], [], []]


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    extra = docs_of(spark, [(None, None), (-5, ""), (-6, "you w0rthl3ss i d i o t"), (-6, "x " * 60_000), (-7, "A kind and open word.")])
    got = toxicity.toxicity(docs.unionByName(extra), labels)
    rows = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == docs.count() + 5 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items() if i is not None)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    held = [i for i in truth if rows[i]["held_out"]]
    assert np.mean([rows[i]["predicted"] == truth[i] for i in held]) >= 0.95
    assert rows[-6]["score"] >= 0 and rows[-7]["predicted"] == 0 and rows[None]["score"] == rows[-5]["score"] < 0.5
    # Equal texts with contradicting labels teach nothing, so reruns agree.
    both = docs_of(spark, [(i, f"{'awful' if i % 2 else 'kind'} text {i // 4}") for i in range(40)])
    said = spark.createDataFrame([(i, i // 2 % 2) for i in range(40)], "doc_id long, toxic int")
    assert len({tuple(sorted((r["doc_id"], r["score"]) for r in toxicity.toxicity(both.repartition(n), said).collect())) for n in (1, 7)}) == 1
    none = toxicity.toxicity(extra, labels.limit(0)).collect()
    assert {r["predicted"] for r in none} == {0} and toxicity.toxicity(docs.limit(0), labels).collect() == []


# --- 7 ---


def brute_substring(rows, window=20):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    place = lambda k, s: (rows[k][0] is None, rows[k][0] or 0, s)
    text = [words(t) for _, t in rows]
    first = {}
    for k in order:
        for s in range(len(text[k]) - window + 1):
            w = tuple(text[k][s : s + window])
            first[w] = min(first.get(w, place(k, s)), place(k, s))
    out = Counter()
    for k, (i, _) in enumerate(rows):
        gone = set()
        for s in range(len(text[k]) - window + 1):
            if first[tuple(text[k][s : s + window])] < place(k, s):
                gone.update(range(s, s + window))
        out[i, len(text[k]), len(gone), hashlib.sha256(b" ".join(w for j, w in enumerate(text[k]) if j not in gone)).hexdigest()] += 1
    return out


def test_substring_dedup(spark):
    rows = corpus()
    got = substring.substring_dedup(docs_of(spark, rows))
    assert Counter(tuple(r) for r in got.collect()) == brute_substring(rows)
    assert substring.substring_dedup(docs_of(spark, rows).limit(0)).collect() == []


def apart(spark, *parts):
    """A table with each of the given lists of rows in a partition of its own."""
    rows = spark.sparkContext.parallelize(parts, len(parts)).flatMap(lambda part: [(i, t, "en", "s", len(t)) for i, t in part])
    return spark.createDataFrame(rows, DOCS)


def test_rows_that_tie_lose_what_an_earlier_document_holds(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    parts = [[(1, passage)], [(5, f"{passage} a b"), (5, f"{passage} c d"), (5, f"{passage} c d")]]
    got = substring.substring_dedup(apart(spark, *parts))
    assert Counter(tuple(r) for r in got.collect()) == brute_substring([r for p in parts for r in p])


def test_hot_anchors_are_dealt_out(spark):
    r = random.Random(9)
    line, passage = " ".join(f"l{i}" for i in range(12)), " ".join(f"p{i}" for i in range(40))
    fill = lambda: " ".join(f"w{r.randint(0, 500)}" for _ in range(15))
    # A line with other words around it, a passage in every part, both again, one row twice, ids that are missing or shared.
    parts = [[(100 * k + i, f"{fill()} {line} {fill()} {passage if i % 4 == k % 4 else ''} {line}") for i in range(20)] for k in range(12)]
    parts += [[(None, f"{passage} z"), (None, f"{passage} y"), (5, f"{passage} x"), (5, f"{passage} x"), (5, f"{line} {passage}"), *parts[3][:2], (7_000, None)]]
    docs, want = apart(spark, *[[(i, t or "") for i, t in p] for p in parts]), brute_substring([r for p in parts for r in p])
    assert Counter(tuple(x) for x in substring.substring_dedup(docs, hot_rows=4).collect()) == want
    assert Counter(tuple(x) for x in substring.substring_dedup(docs).collect()) == want


def test_a_chain_of_more_words_than_16_bits(spark):
    r = np.random.default_rng(8)
    # A gram whose hash is the least of many is the anchor of all windows of a text that repeats it every 13 words.
    many = r.integers(0, 50_000, 3_000_000)
    grams = common.windows(common.word_hashes([" ".join(map(str, many.tolist())).encode()])[0], substring.GRAM, base=0xC2B2AE3D27D4EB4F)
    gram = many[(k := int(np.argmin(grams))) : k + substring.GRAM].tolist()
    long = [str(w) for _ in range(6_000) for w in [*gram, *r.integers(0, 50_000, 5).tolist()]]
    parts = [[(1, " ".join(long[70_000:70_100]))], [(2, " ".join(long))]]
    got = substring.substring_dedup(apart(spark, *parts))
    assert Counter(tuple(r) for r in got.collect()) == brute_substring([r for p in parts for r in p])


def test_anchor_is_the_least_gram():
    g = np.random.default_rng(0).integers(0, 50, 300).astype(np.uint64)
    assert substring.anchors(g, 13).tolist() == [i + int(np.argmin(g[i : i + 13])) for i in range(288)]


# --- 8 ---

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def brute_spans(text):
    found = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(KINDS) for m in re.finditer(p, text or "") if valid(kind, m[0]))
    return ",".join(f"{KINDS[k][0]}:{a}:{z}" for a, k, z in found)


PERSONAL = [(None, None), (-1, ""), (-2, "a@b.c_d@e.f x@y 1.2.3.4.5.6.7.8 300.1.1.1 é+33 (0)1.22-33 44 55 4111 1111 1111 1111 😀a%b@c.d.e- 0001.2.3.0255"), (-2, "a@b.c"), (-3, "9" * 30_000 + " 4111111111111111"), (-4, "x" * 50_000 + "@"), (-5, "a@b.co" * 2_000), (-6, "+1" + "(" * 20_000 + " +49 (30) 1234567-8)"), (-7, "1-2 3-4 " * 3_000 + "1.2.3.4")]


def test_base_spans(spark):
    rows = PERSONAL + corpus() + [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = pii.find_personal_data(docs_of(spark, rows))
    want = Counter((i, hashlib.sha256(brute_spans(t).encode()).hexdigest()) for i, t in rows)
    assert Counter((r["doc_id"], r["base_sha256"]) for r in got.collect()) == want
    assert pii.find_personal_data(docs_of(spark, rows).limit(0)).collect() == []


def test_terms_that_reveal_a_value(spark):
    r = random.Random(2)
    fill = lambda n: " ".join(r.choice(["lorem", "ipsum", "dolor", "amet", "elit", "sed"]) + str(r.randint(0, 99)) for _ in range(n))
    plain = [" ".join(r.choice(["lorem", "ipsum", "dolor", "amet", "elit", "magna", "later", "again", "writes", "from"]) for _ in range(30)) for _ in range(200)]
    rows = list(enumerate(plain)) + [(1000 + i, f"{fill(6)} lorem Zweistein, ask z@x.org {fill(5)} dolor. Later zweistein again") for i in range(6)]
    # Copies of one context say nothing new.
    rows += [(2000 + i, "ipsum Onlycopy writes from c@x.org dolor") for i in range(9)]
    got = {x["doc_id"]: x for x in pii.find_personal_data(docs_of(spark, rows)).collect()}
    assert all(got[i]["n_term"] == 0 for i in range(200)) and all(got[2000 + i]["n_term"] == 0 for i in range(9))
    for i in range(6):
        text = rows[200 + i][1]
        spans = [s.split(":") for s in got[1000 + i]["spans"].split(",")]
        assert [text[int(a) : int(z)].lower() for k, a, z in spans if k == "term"] == ["zweistein"] * 2
        assert got[1000 + i]["base_sha256"] == hashlib.sha256(brute_spans(text).encode()).hexdigest()
    clean = {x["doc_id"]: x["clean_text"] for x in pii.sanitise(docs_of(spark, rows[-3:] + [(1, None), (2, "no")])).collect()}
    assert clean[2008] == "ipsum Onlycopy writes from <email> dolor" and clean[1] is None and clean[2] == "no"


def test_terms_beside_a_value_with_one_signature(spark):
    r = random.Random(4)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgkl" for b in "aeiou" for c in "mnrst"]
    fill = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    rows = [(i, fill(60)) for i in range(300)]
    # One signature under different texts; a short name; a name far from its value.
    rows += [(1000 + i, f"{fill(60)} Yours Bob Quistrom bob@x.org phone {fill(30)}") for i in range(30)]
    rows += [(2000 + i, f"{fill(40)} Wo Farawaysson {fill(40)} far@x.org end") for i in range(5)]
    # Near copies, edited beside the value too, are one context.
    base = fill(120).split()
    for i in range(9):
        own = [*base]
        own[i * 9] = "edited"
        rows.append((3000 + i, f"{' '.join(own)} Copyman e{'abcdefghi'[i]} c@x.org {'jklmnopqr'[i]}x"))
    got = {x["doc_id"]: x["spans"] for x in pii.find_personal_data(docs_of(spark, rows)).collect()}
    terms = {i: {t[int(a) : int(z)].lower() for k, a, z in (s.split(":") for s in got[i].split(",") if s) if k == "term"} for i, t in rows}
    assert all({"bob", "quistrom"} <= terms[1000 + i] for i in range(30))
    assert all({"wo", "farawaysson"} <= terms[2000 + i] for i in range(5))
    assert all(not terms[i] for i in [*range(300), *range(3000, 3009)])


def brute_terms(rows, context=300, support=3, disclosure=0.9):
    """All spans of each row: base ones, and terms by counting contexts, documents and copies in plain Python (ASCII texts)."""
    term = re.compile(r"(?<!\S)(?:[A-Za-z]{4,}|[A-Z][A-Za-z]{0,2})(?=[.,;:!?]*(?:\s|$))")
    base = [[(int(a), int(z), k) for k, a, z in (x.split(":") for x in brute_spans(t).split(",") if x)] for _, t in rows]
    seen, near = {}, {}
    for u, (_, t) in enumerate(rows):
        for a, z, kind in base[u]:
            value = t[a:z].lower() if kind == "email" else t[a:z] if kind == "ip" else re.sub("[^0-9]", "", t[a:z])
            left, right = t[max(0, a - context) : a], t[z : z + context]
            left = re.sub(r"^\S+", "", left) if a > context else left
            right = re.sub(r"\S+$", "", right) if len(right) == context else right
            beside = (next(iter(re.findall(r"(\S+)\s*$", left.lower())), ""), next(iter(re.findall(r"^\s*(\S+)", right.lower())), ""))
            seen.setdefault((kind, value), {}).setdefault(u, set()).add(beside)
            for w in {w.lower() for w in term.findall(left) + term.findall(right)}:
                near.setdefault((kind, value, w), {}).setdefault(u, set()).add(beside)
    copy = {}
    for u, (_, t) in enumerate(rows):
        own = shingles(t)
        copy[u] = next((copy[v] for v in range(u) if 100 * len(own & shingles(rows[v][1])) >= 80 * len(own | shingles(rows[v][1]))), u)
    found, n = {}, len(rows)
    for (kind, value, w), docs in near.items():
        n_e = len(seen[kind, value])
        most = {}
        for u, contexts in docs.items():
            most[copy[u]] = max(most.get(copy[u], 0), len(contexts))
        df = sum(w in re.split("[^a-z]+", t.lower()) for _, t in rows)
        whole = math.log2(n / n_e)
        if sum(map(len, seen[kind, value].values())) >= support and sum(most.values()) >= support and whole > 0 and math.log2(n * len(docs)) - math.log2(n_e * df) >= disclosure * whole - 1e-12:
            for u in seen[kind, value]:
                found.setdefault(u, set()).add(w)
    out = Counter()
    for u, (i, t) in enumerate(rows):
        spans = [(a, KINDS_ORDER.index(k), z) for a, z, k in base[u]]
        for w in found.get(u, ()):
            spans += [(m.start(), 4, m.end()) for m in re.finditer(rf"(?i)(?<!\S){re.escape(w)}(?=[.,;:!?]*(?:\s|$))", t) if not any(a < m.end() and m.start() < z for a, z, _ in base[u])]
        out[i, ",".join(f"{KINDS_ORDER[k]}:{a}:{z}" for a, k, z in sorted(set(spans)))] += 1
    return out


KINDS_ORDER = ["email", "ip", "card", "phone", "term"]


def test_terms_against_brute_force(spark):
    r = random.Random(17)
    vocabulary = ["lorem", "Ipsum", "dolor", "amet", "elit", "Al", "sed", "magna", "and", "of", "Ut", "tempor"]
    fill = lambda n: " ".join(r.choice(vocabulary) + r.choice(["", "", "", ",", "."]) for _ in range(n))
    people = [(f"name{chr(97 + k)}@x.org", f"Person{chr(97 + k)}son", r.randint(1, 9)) for k in range(12)] + [("10.0.0.7", "Hosty", 5), ("+49 30 1234567", "Bo", 4)]
    rows = [(i, fill(r.randint(1, 60))) for i in range(60)]
    for value, name, times in people:
        for _ in range(times):
            parts = [fill(r.randint(0, 80)), name if r.random() < 0.9 else "", fill(r.randint(0, 30)), value, fill(r.randint(0, 60)), r.choice([name.lower(), "", f"{value} {name}!"])]
            rows.append((len(rows), " ".join(p for p in parts if p)))
    rows += [(500, rows[70][1])] * 4
    got = Counter((x["doc_id"], x["spans"]) for x in pii.find_personal_data(docs_of(spark, rows)).collect())
    want = brute_terms(rows)
    assert got == want and sum(s.count("term:") for _, s in want) > 20


# --- 9 ---


def test_contained_items(spark):
    rows = corpus()
    texts = [t for _, t in rows if t]
    items = [(1, " ".join(texts[0].split()[:40])), (2, " ".join(texts[55].split()[3:30])), (3, "never seen words at all here"), (4, None), (5, "A B C"), (6, ""), (7, " ".join([*texts[60].split()[:30], "new", "words"])), (None, texts[44])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter()
    for i, t in rows:
        for k, u in items:
            own, shared = shingles(u), shingles(u) & shingles(t)
            if own and 100 * len(shared) >= 80 * len(own):
                want[i, k, len(own), len(shared)] += 1
    docs = docs_of(spark, rows)
    assert sum(want.values()) > 10
    assert Counter(tuple(r) for r in decontam.contained_items(docs, bench).collect()) == want
    assert Counter(tuple(r) for r in decontam.contained_items(docs, bench, block_shingles=30).collect()) == want
    clean = decontam.without_items(docs.withColumnRenamed("lang", "item_id"), bench)
    bad = {i for i, *_ in want}
    assert "item_id" in clean.columns and not {r["doc_id"] for r in clean.collect()} & (bad - {7, 100, None}) and clean.count() == sum(1 for i, t in rows if not any(shingles(u) and 100 * len(shingles(u) & shingles(t)) >= 80 * len(shingles(u)) for _, u in items))
    assert decontam.contained_items(docs, bench.limit(0)).collect() == [] == decontam.contained_items(docs.limit(0), bench).collect()


def test_ordered_shingles():
    texts = [b"a b c d e f a b c d e", None, b"", b"X y", b"one two three four five", b"a b c d E F"]
    h, at = decontam.ordered_shingles(texts)
    assert np.diff(at).tolist() == [7, 0, 0, 1, 1, 2] and h[0] == h[6] and (h[:2] == h[9:]).all()
    sets, bounds = common.shingle_sets(texts)
    assert all(np.array_equal(np.unique(h[at[i] : at[i + 1]]), sets[bounds[i] : bounds[i + 1]]) for i in range(len(texts)))


def test_pieces_find_what_every_look_up_finds(spark):
    r = random.Random(12)
    text = lambda n: [f"w{r.randint(0, 3_000)}" for _ in range(n)]
    items = [text(n) for n in [1, 3, 5, 6, 8, 9, 12, 19, 20, 21, 35, 36, 40, 67, 68, 120, 400] for _ in range(6)]
    rows = []
    for k in range(240):
        body, item = text(r.choice([3, 60, 700, 4_000])), list(items[k % len(items)])
        if len(item) > 30 and k % 2:
            item[r.randrange(len(item))] = "edited"
            item.insert(r.randrange(len(item)), "more")
        place = r.randint(0, len(body))
        rows.append((k, " ".join(item if len(item) < 5 else [*body[:place], *item, *body[place:]])))
    # A line of an item that many documents share, without the rest.
    rows += [(1_000 + k, " ".join([*text(40), *items[-1][:30], *text(40)])) for k in range(60)] + [(None, " ".join(items[50])), (5, " ".join(items[50])), (5, " ".join(items[50])), (2_000, None)]
    docs, bench = docs_of(spark, rows), spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(0, " ".join(items[50])), (None, "")], "item_id long, text string")
    found, whole = (Counter(tuple(x) for x in decontam.contained_items(docs, bench, exact=e).collect()) for e in (False, True))
    assert not found - whole and sum(found.values()) >= 0.995 * sum(whole.values()) > 230
    bad = {x[0] for x in found}
    assert Counter(x["doc_id"] for x in decontam.without_items(docs, bench).collect()) == Counter(i for i, _ in rows if i not in bad)


# --- 10 ---


def test_shards(spark):
    rows = [(i, f"text {i} " + "y" * (i * 37 % 200)) for i in range(3_000)] + [(5_000 + i, "hot " * 20) for i in range(1_500)] + corpus()
    got = sharding.shard_documents(docs_of(spark, rows)).collect()
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want and {r["law"] for r in got} == {"bytes"}
    for s in range(40):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(1 for r in got if r["shard"] == s)))
    mean = sum(sizes.values()) / 40
    # The one text of 9,000 words outweighs a shard's share; the others are near.
    assert set(sizes) <= set(range(40)) and sum(abs(v - mean) < 0.1 * mean for v in sizes.values()) >= 30
    # Copies of a light text stay together.
    assert len({r["shard"] for r in got if r["text_crc32"] == zlib.crc32(b"A b c")}) == 1
    assert sharding.shard_documents(docs_of(spark, rows).limit(0)).collect() == []
    clash = docs_of(spark, rows[:50]).withColumnsRenamed({"lang": "shard", "source": "hi"})
    assert sharding.with_shards(clash, 4).columns == [*clash.columns, "size", "_shard", "slot"]


def test_splitters_against_sorted_keys(spark):
    r = random.Random(21)
    rows = [(r.getrandbits(63), r.getrandbits(63) - 2**62, r.randint(16, 3_000)) for _ in range(1_500)]
    # Copies of two texts, one of which outweighs a shard, and rows that are equal in all.
    rows += [(77, i * 2**40, 500) for i in range(600)] + [(-5, i, 40) for i in range(30)] + [(9, 9, 100)] * 20
    unsigned = lambda x: x + 2**63
    keys = sorted(((unsigned(h) << 64) | unsigned(lo), w) for h, lo, w in rows)
    total, below, seen = sum(w for _, w in keys), {}, 0
    for n, (k, w) in enumerate(keys):
        below.setdefault(k, (seen, n))
        seen += w
    below[keys[-1][0] + 1] = (total, len(keys))
    cuts, before = sharding.splitters(spark.createDataFrame(rows, "hi long, lo long, weight long").repartition(3), 20)
    assert len(cuts) == 19 and before[0] == 0
    for i, (cut, n) in enumerate(zip(cuts, before[1:], strict=True), 1):
        under = (sum(w for k, w in keys if k < cut), sum(k < cut for k, _ in keys))
        nearest = min(abs(w - total * i / 20) for w, _ in below.values())
        assert under[1] == n and abs(under[0] - total * i / 20) <= max(0.005 * total / 20, nearest) + 1e-9


def test_many_ranges_a_shard(spark):
    got = sharding.with_shards(docs_of(spark, [(i, "z" * (i % 50)) for i in range(2_000)]), 3, part_rows=100).collect()
    for s in range(3):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(1 for r in got if r["shard"] == s)))


def test_further_columns_may_have_any_name(spark):
    taken = "node bands component group least text_key anchor row_key low high spans uid hits kind start end piece h item row weight part hi lo range_key mix_row mix_source k rank size shard slot score label_id".split()
    rows = [(1, "alpha beta gamma delta epsilon zeta a@b.co " * 4, "s"), (1, "alpha beta gamma delta epsilon zeta a@b.co " * 4, "s"), (None, None, None), (2, "", "t"), (3, "one two", "t")]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = plain.select("*", *(F.lit(f"mine {c}").alias(c) for c in taken))
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta"), (None, None)], "item_id long, text string").select("*", *(F.lit(0).alias(c) for c in ("item", "h", "uid", "shingles")))
    runs = [neardup.near_duplicates, substring.substring_dedup, pii.find_personal_data, mixing.mixture, sharding.shard_documents, lambda d: decontam.contained_items(d, bench)]
    for run in runs:
        digest = lambda df: Counter(tuple(x[c] for c in df.columns if c not in ("shard", "slot")) for x in df.collect())
        assert digest(run(docs)) == digest(run(plain))
    stages = [neardup.one_of_each, lambda d: decontam.without_items(d, bench), mixing.mixed]
    for stage, n in zip(stages, (4, 3, None), strict=True):
        out = stage(docs)
        assert out.columns == docs.columns and (n is None or out.count() == n)


def test_all_queries_are_registered():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 11)) and set(queries.ORACLE_SQL) <= set(queries.QUERIES)
