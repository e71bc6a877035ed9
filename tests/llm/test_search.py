"""Duplicates, substrings, decontamination, fingerprints, pages, pipeline: against brute force, and awkward rows."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import components, decontaminate, jaccard, kernels, pages, queries, simhash, substrings

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOWEST = -(1 << 63)


def low(doc_id):
    return LOWEST if doc_id is None else doc_id


# --- kernels ------------------------------------------------------------------------------

def test_words_against_pattern():
    texts = ["a b", "", "Ünï\x85x  y\x0b", " z", "q", "\x1fA\x00b\u2003c"]
    data, offsets = kernels.column_bytes(pa.array([*texts, None]))
    for table, pattern in ((kernels.SPACE_WORDS, r"[^\x20\x09-\x0D]+"), (kernels.ALNUM_WORDS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        s, e, row = kernels.words(data, offsets, table)
        low_bytes = kernels.LOWER[data]
        got = [(int(r), low_bytes[a:b].tobytes().decode()) for a, b, r in zip(s, e, row, strict=True)]
        assert got == [(i, w) for i, t in enumerate(texts) for w in re.findall(pattern, t.translate(LOWER))]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (7, 1100)]
    random.Random(1).shuffle(edges)
    got = {r["node"]: r["label"] for r in components.components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(got.values()) == {0} and len(got) == 301 + 200
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- Jaccard ------------------------------------------------------------------------------

def brute_groups(rows, k, threshold):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        sets.append({tuple(w[i:i + k]) for i in range(max(len(w) - k, 0) + 1)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), low(d)), low(d))
    return sorted((low(d), len(sets[i]), least[root(i)] if sets[i] else low(d)) for i, (d, _) in enumerate(rows))


def shown(frame):
    return sorted((low(r["doc_id"]), r["n_shingles"], low(r["component_id"])) for r in frame.collect())


@pytest.mark.parametrize("k,threshold", [(3, 90), (5, 80), (1, 50)])
def test_groups_against_brute_force(odd_documents, k, threshold):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    assert shown(jaccard.near_duplicates(odd_documents, k, threshold)) == brute_groups(rows, k, threshold)


def near_copies(n, seed=5):
    pick = random.Random(seed)
    base = [f"w{pick.randint(0, 3000)}" for _ in range(150)]
    rows = []
    for i in range(n):
        w = list(base[:150 - pick.randint(0, 12)])
        for _ in range(pick.randint(0, 4)):
            w[pick.randrange(len(w))] = f"n{pick.randint(0, 10 ** 6)}"
        rows.append((i * 3 + 1, " ".join(w)))
    return rows


def test_large_group_in_sub_blocks(spark, monkeypatch):
    """A group that is cut into pairs of sub-blocks, with salted columns, gives the same groups."""
    rows = near_copies(120)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = brute_groups(rows, 3, 90)
    assert shown(jaccard.near_duplicates(docs, 3, 90)) == want
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", 1500)
    monkeypatch.setattr(jaccard, "HOT_COLUMN", 10)
    assert shown(jaccard.near_duplicates(docs, 3, 90)) == want
    assert 1 < len({c for _, _, c in want}) < 120


def brute_rows(rows, k, threshold):
    """The row of least (doc_id, text) of each component; rows without words only lose repeats."""
    least: dict = {}
    alone = set()
    marks = [(i, text) for i, (_, text) in enumerate(rows)]  # row numbers as ids: components of rows
    for (i, n, label) in brute_groups(marks, k, threshold):
        d, text = rows[i]
        if n:
            least[label] = min(least.get(label, (low(d), text)), (low(d), text))
        else:
            alone.add((low(d), text))
    return sorted([*least.values(), *alone], key=str)


@pytest.mark.parametrize("block", [500_000, 300])
def test_rows_of_null_and_repeated_ids_stay(spark, odd_documents, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    pick = random.Random(4)
    other = [" ".join(f"t{i}x{j}" for j in range(40)) for i in range(12)]
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    # an id that comes with a clean text and with a copy of another document
    rows += [(None, other[0]), (None, other[1]), (25, other[0]), (27, other[2]), (27, other[3] + " b"), (3, other[3]),
             (None, None), (None, ""), (None, ""), (None, "  "), (4, "")]
    for _ in range(60):  # near copies under null and few ids
        rows.append((pick.choice([None, None, 31, 32, 33]), pick.choice(other[4:]) + pick.choice(["", " u", " v", " w"])))
    pick.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "en", "a", 1) for d, t in rows], odd_documents.schema).repartition(7)
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    kept = sorted(((low(r["doc_id"]), r["text"]) for r in got.collect()), key=str)
    assert kept == brute_rows(rows, 5, 80)
    assert {other[0], other[1], other[2], other[3]} <= {t for _, t in kept}


def test_bitmaps_never_lose_a_link():
    """The pairs within the bitmaps' bound connect all that links connect, for sets of very different sizes."""
    pick = random.Random(8)
    for threshold in (50, 80, 90):
        sets = [frozenset(pick.getrandbits(64) for _ in range(pick.choice([1, 2, 5, 30, 70, 400]))) for _ in range(30)]
        for s in list(sets):
            for _ in range(2):
                kept = [x for x in s if pick.random() < pick.choice([1, 0.95, 0.8, 0.5])] or list(s)[:1]
                sets.append(frozenset(kept + [pick.getrandbits(64) for _ in range(int(len(s) * pick.choice([0, 0.05, 0.2])))]))
        of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        shingle = np.array([x for s in sets for x in sorted(s)], np.uint64)
        words, first = jaccard.signatures(of, shingle, len(sets))
        bitmaps = [words[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        parent = list(range(len(sets)))

        def root(i, parent=parent):
            while parent[i] != i:
                i = parent[i]
            return i
        for i, j in jaccard.possible_links(np.array([len(s) for s in sets]), bitmaps, threshold):
            parent[root(i)] = root(j)
        links = [(i, j) for i in range(len(sets)) for j in range(i)
                 if 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
        assert len(links) > 20 and all(root(i) == root(j) for i, j in links)
        assert len({root(i) for i in range(len(sets))}) > 20   # and what is far apart stays apart


@pytest.mark.parametrize("one_id", [None, 7])
def test_a_third_of_the_rows_share_an_id(spark, one_id):
    pick = random.Random(3)
    rows = []
    for i in range(120):
        words = [f"w{pick.randint(0, 900)}" for _ in range(pick.choice([8, 40, 60]))]
        rows.append((one_id if i % 3 == 0 else i, " ".join(words)))
        rows.append((one_id if i % 3 == 0 else 1000 + i, " ".join(words + ["more"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert shown(jaccard.near_duplicates(docs, 3, 90)) == brute_groups(rows, 3, 90)
    kept = jaccard.keep_one(docs.select("*", *[F.lit("mine").alias(c) for c in ("k1", "n", "what", "rep", "label", "task")]), 3, 90)
    assert len(kept.columns) == 8
    groups = brute_groups(rows, 3, 90)
    alone = {t for d, t in rows if len(t.split()) == 8}             # nine words against eight: 6 of 7 shingles, no link
    assert {r["text"] for r in kept.collect()} >= alone and kept.count() < len(rows) and len(groups) == len(rows)


def test_no_documents_no_groups(no_documents):
    assert jaccard.near_duplicates(no_documents).count() == 0


# --- substrings ---------------------------------------------------------------------------

def brute_removal(rows, length):
    first: dict = {}
    for d, t in rows:
        for i in range(len(t) - length + 1):
            s = t[i:i + length]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - length + 1):
            if first[t[i:i + length]] < d:
                gone[i:i + length] = True
        gone = gone[:-1]
        heads = int((gone & ~np.concatenate([[False], gone])[:len(gone)]).sum())
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        out.append((d, len(t), int(gone.sum()), heads, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block,hot", [(16 << 20, 4096), (20_000, 2)])
def test_removal_against_brute_force(spark, odd_documents, documents, monkeypatch, block, hot):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", block)
    monkeypatch.setattr(substrings, "HOT", hot)
    for docs in (odd_documents, documents.where("doc_id < 150"),
                 spark.createDataFrame(near_copies(40), "doc_id long, text string")):
        rows = [(low(r["doc_id"]), (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
        got = sorted((low(r["doc_id"]), *tuple(r)[1:5]) for r in substrings.remove_repeats(docs).collect())
        assert got == brute_removal(rows, 50)


def test_suffix_order_is_the_suffix_array():
    pick = np.random.default_rng(1)
    for n, letters in ((1, 2), (5, 2), (200, 2), (2000, 3), (3000, 256), (500, 1), (0, 1)):
        t = pick.integers(0, letters, n).astype(np.uint8)
        raw = t.tobytes()
        order, _ = substrings.suffix_order(t, 50)
        assert sorted(order.tolist()) == list(range(n))
        assert [raw[i:i + 50] for i in order] == [raw[i:i + 50] for i in sorted(range(n), key=lambda i: raw[i:])]


def test_removal_of_nothing(no_documents):
    assert substrings.remove_repeats(no_documents).count() == 0


# --- decontamination ----------------------------------------------------------------------

def brute_hits(docs, items, size=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    out = []
    for d, text in docs:
        w, hit, names = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(len(v), size)
            for j in range(len(v) - n + 1 if n else 0):
                for i in range(len(w) - n + 1):
                    if w[i:i + n] == v[j:j + n]:
                        hit.update(range(i, i + n))
                        names.add("" if item is None else str(item))
        out.append((low(d), len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


@pytest.mark.parametrize("windows", [100_000, 5])
def test_hits_against_brute_force(spark, odd_documents, clashing, no_documents, monkeypatch, windows):
    """One block of windows, and a benchmark beyond the size of a block."""
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", windows)
    text = odd_documents.where("doc_id = 9").first()["text"]
    items = [(1, text[60:220]), (2, "TWO words"), (3, None), (4, ""), (10, "again"), (None, "no ID at"), (1, "short"), (5, "absent item")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = decontaminate.find_contamination(clashing, bench)
    assert len(got.columns) == len(set(got.columns))
    assert sorted((low(r["doc_id"]), *[r[c] for c in names]) for r in got.collect()) == brute_hits(rows, items)
    assert decontaminate.find_contamination(no_documents, bench).count() == 0
    none = decontaminate.find_contamination(odd_documents, bench.limit(0))
    assert none.where("contaminated").isEmpty() and none.count() == len(rows)


def test_one_huge_item_and_a_window_of_many_items(spark, odd_documents, monkeypatch):
    """Blocks stay small where one item (or the null id) has nearly all windows, or one window nearly all items."""
    monkeypatch.setattr(decontaminate, "BLOCK_WINDOWS", 40)
    sizes = []
    plain = decontaminate._Windows.__init__
    monkeypatch.setattr(decontaminate._Windows, "__init__", lambda self, *a: sizes.append(len(a[0])) or plain(self, *a))
    text = odd_documents.where("doc_id = 9").first()["text"]
    items = [("huge", text), (None, text[200:900]), ("huge", text)] + [(f"i{i}", "two words") for i in range(100)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    got = decontaminate.find_contamination(odd_documents, bench).collect()
    assert sorted((low(r["doc_id"]), *[r[c] for c in names]) for r in got) == brute_hits(rows, items)
    assert len(sizes) > 4 and max(sizes) < 80


# --- fingerprints -------------------------------------------------------------------------

def test_next_document_and_edited_text(odd_documents, documents, no_documents, monkeypatch):
    monkeypatch.setattr(simhash, "RANGE_BYTES", 20_000)  # many ranges and ghosts
    for docs in (odd_documents, documents, documents.limit(1)):
        rows = sorted(((low(r["doc_id"]), r["text"] or "") for r in docs.collect()))
        got = sorted(simhash.compare_with_next(docs).collect(), key=lambda r: (low(r["doc_id"]), r["n_chars"]))
        assert len(got) == len(rows)
        marks: dict = {}
        for i, ((d, t), r) in enumerate(zip(rows, got, strict=True)):
            quarter = len(t) // 4
            edited = t[:len(t) - quarter] + rows[(i + 1) % len(rows)][1][:quarter]
            assert (low(r["doc_id"]), r["n_chars"], r["edited_sha256"]) == (d, len(t), hashlib.sha256(edited.encode()).hexdigest())
            assert marks.setdefault(t, r["fingerprint"]) == r["fingerprint"]
            a, b, c = (int(x, 16) for x in (r["fingerprint"], r["edited_fingerprint"], got[(i + 1) % len(got)]["fingerprint"]))
            assert (r["near_edited"], r["near_next"]) == (1 - (a ^ b).bit_count() / 128, 1 - (a ^ c).bit_count() / 128)
    assert simhash.compare_with_next(no_documents).count() == 0


def test_search_finds_all_within_radius(spark):
    pick = random.Random(2)
    marks = [pick.getrandbits(128) for _ in range(60)]
    for m in list(marks[:40]):
        for flips in (1, 4, 6, 7, 9):
            x = m
            for b in pick.sample(range(128), flips):
                x ^= 1 << b
            marks.append(x)
    entries = spark.createDataFrame([(f"{m:032x}",) for m in marks + marks[:5]], "fingerprint string")
    queries = entries.limit(50)
    got = sorted((r["fingerprint"], r["near"], r["distance"]) for r in simhash.find_near(queries, entries, 6).collect())
    asked = {r["fingerprint"] for r in queries.collect()}
    want = sorted({(a, f"{m:032x}", (int(a, 16) ^ m).bit_count()) for a in asked for m in marks
                   if (int(a, 16) ^ m).bit_count() <= 6})
    assert got == want


def test_fingerprint_query_searches_all_rows(spark, no_documents, tmp_path):
    pick = random.Random(6)
    base = " ".join(f"w{pick.randint(0, 300)}" for _ in range(4000))
    texts = [base, base + " one", base + "".join(f" y{j}" for j in range(80)), "else " * 50, None, ""]
    rows = [(pick.choice([None, 50, i * 10, i * 25, i]), pick.choice(texts)) for i in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op10_fingerprints"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    marks = [(r["doc_id"], int(r["fingerprint"], 16)) for r in got]
    value = lambda d: int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:13], 16)
    for i, r in enumerate(got):
        near = [d for j, (d, m) in enumerate(marks) if j != i and (m ^ marks[i][1]).bit_count() <= 6]
        want = (len(near), str(sum(map(value, near)))) if r["doc_id"] is not None and r["doc_id"] % 50 == 0 else (None, None)
        assert (r["n_near"], r["near_digest"]) == want
    assert any(r["n_near"] for r in got) and len({m for _, m in marks}) > 3
    assert simhash.compare_and_search(no_documents).count() == 0


def test_near_copies_have_near_fingerprints(spark):
    rows = near_copies(20) + [(999, "nothing " + " ".join(f"z{i}" for i in range(150)))]
    got = {r["doc_id"]: int(r["fingerprint"], 16) for r in simhash.fingerprint(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    near = [(got[1] ^ v).bit_count() for d, v in got.items() if d != 999]
    assert max(near) < 40 <= (got[1] ^ got[999]).bit_count()


# --- pages --------------------------------------------------------------------------------

def table_length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("table", [1 << 28, 4])
def test_common_subsequence(monkeypatch, table):
    monkeypatch.setattr(pages, "TABLE_BITS", table)
    pick = random.Random(2)
    for _ in range(1500):
        a, b = ([pick.randint(0, 4) for _ in range(pick.randint(0, 12))] for _ in range(2))
        at = pages.common(a, b)
        rest = iter(b)
        assert at == sorted(set(at)) and all(a[i] in rest for i in at) and len(at) == table_length(a, b)


def test_marked_pages():
    page = ('<html><head><title>t</title><style>p{}</style></head><body><header>site</header><nav><a>m</a></nav><!-- c -->'
            '<div class="ad">buy</div><main><article><header><h1>Head</h1></header><script>var t="</p>";</script>'
            '<p>a &amp; b<b>c</b>\n d<br>e &#233;<p>two<form><input value="x">f</form><div class="comments">nice</div>'
            '</article></main><aside>s</aside><footer>&copy;</footer>')
    assert [t for t, m in pages.lines(page) if m == pages.ARTICLE] == ["Head", "a & bc d e é", "two"]
    assert pages.lines("<p title=\"a>b\">t</p><p x=\"") == [("t", pages.OPEN)]
    assert pages.lines("a < b &lt; c") == [("a < b < c", pages.OPEN)]
    assert pages.lines("") == [] and pages.lines("<article><p>cut sho") == [("cut sho", pages.ARTICLE)]


def test_comments_self_closing_and_omitted_end_tags():
    def kept(page):
        own = pages.lines(page)
        marked = [t for t, m in own if m == pages.ARTICLE]
        return marked or [t for t, m in own if m == pages.OPEN]
    comment = "<div class=post>text</div><section id=comments><article class=comment>nice</article></section>"
    assert kept(comment) == ["text"] and kept("<div>text</div><article class='comment odd'>nice</article>") == ["text"]
    assert kept("<section class=related><article class=card>x</article></section><article>text</article>") == ["text"]
    assert kept('<p>a<svg width="1"/>b<p>c<math />d<svg><path/>no</svg>e') == ["ab", "cde"] == kept('<p>a<svg/>b<p>c<math/>de')
    assert kept("<p class=ad>x<p>text<p>more") == ["text", "more"] == kept("<p class=ad>x<div>text</div><p>more</p>")
    assert kept("<ul><li class=ad>x<li>text<ul><li>more</ul></ul>") == ["text", "more"]
    assert kept("<ul><li class=ad>x<ul><li>y</ul>z<li>text</ul>") == ["text"]
    assert kept("<dl><dt class=ad>x<dd>text<dt>more</dl>") == ["text", "more"]
    assert kept("<table><tr class=ad><td>x<tr><td class=ad>y<td>text<table><tr><td>more</table></table>") == ["text", "more"]
    # what the page has, its topic or its state does not make it boilerplate
    assert kept("<body class='has-sidebar'><article class='post tag-social'>text</article>") == ["text"]
    assert kept("<form id=page><article>text</article><p>f</form>") == ["text"]
    assert kept("<div class=with-sidebar><main>text</main></div>") == ["text"]


def test_differencing_of_unmarked_pages(spark):
    frame = "<div>Site name</div><div>Menu</div>{}<div>About us</div>"
    rows = [(i, f"http://h.example/{i:03d}?q={i}", frame.format(f"<p>text {i}</p><p>more {i}</p>")) for i in range(60)]
    rows += [(100, "http://alone.example/x", frame.format("<p>only</p>")), (101, None, None), (102, "", ""),
             (103, "http://h.example/003", rows[3][2]), (103, "http://h.example/003", rows[3][2])]
    got: dict = {}
    for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(6)).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
    assert all(got[i] == [f"text {i}\n\nmore {i}"] for i in range(60))
    assert got[100] == ["Site name\n\nMenu\n\nonly\n\nAbout us"] and got[101] == [""] == got[102]
    assert got[103] == ["text 3\n\nmore 3"] * 2
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_page_table(spark, monkeypatch):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").withColumn("row", F.lit("mine")).withColumn("gone", F.lit(1))
    rows = {r["page_id"]: r for r in table.collect()}
    got = pages.extract(table).collect()
    assert len(got) == len(rows)
    for r in got:
        body = rows[r["page_id"]]["html"].partition("<article>")[2].partition("</article>")[0]
        want = [" ".join(pages.references.unescape(re.sub(r"<br>", " ", x)).split())
                for x in re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<[^>]*\Z", "", body))]
        assert r["text"] == "\n\n".join(w for w in want if w) and r["n_chars"] == len(r["text"])
