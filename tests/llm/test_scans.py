"""License scans and periodic runs: results against brute force, and awkward rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import licences, periods, queries
from ledgerlake.llm.kernels import mix

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- licences -----------------------------------------------------------------------------

def base_places(text: str) -> tuple[int, list[tuple[int, str]]]:
    w = WORD.findall((text or "").translate(CAPITALS))
    out = []
    for phrase, label in licences.BASE.items():
        p = phrase.split()
        out += [(i, label) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), sorted(out)


def test_license_query_against_brute_force(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = queries.QUERIES["op11_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(texts)
    seen = 0
    for r in rows:
        n, places = base_places(texts[r["doc_id"]])
        labels = sorted({x for _, x in places})
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (n, len(places), ",".join(labels))
        assert (r["first_word"], r["last_word"]) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert set(labels) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "")
        seen += bool(places)
    assert seen > 5


PIECES = ["under", "the", "MIT", "license", "Apache", "version", "2", "CC", "by", "nc", "sa", "or", "é", "with", ",", "\n", "-",
          "Licensed", "under the mit license", "apache license, version 2", "cc by-nc", "2.0", "versión", "ﬁ"]


def test_places_of_random_texts(spark):
    pick = random.Random(5)
    rows = [(i, " ".join(pick.choice(PIECES) for _ in range(pick.randint(0, 25)))) for i in range(3000)]
    found = licences.scan_licences(spark.createDataFrame(rows, "doc_id long, text string"), keep=["doc_id"]).collect()
    for r in found:
        n, places = base_places(rows[r["doc_id"]][1])
        assert r["n_words"] == n
        assert sorted((f["word"], f["label"]) for f in r["findings"] if f["kind"] == "base") == places
        for f in r["findings"]:  # offsets are code points of the text itself
            text = rows[r["doc_id"]][1][f["start"]:f["end"]]
            assert len(WORD.findall(text.translate(CAPITALS))) == f["n_words"]


def grammar(tokens: list[str]):
    """A recursive reader of the same expressions, as a nested tuple."""
    at = 0

    def operand():
        nonlocal at
        token = tokens[at]
        at += 1
        if token == "(":
            inner = level(1)
            at += 1
            return inner
        return token

    def level(p):
        nonlocal at
        left = operand() if p > 3 else level(p + 1)
        while p <= 3 and at < len(tokens) and licences.PRECEDENCE.get(tokens[at]) == p:
            op = tokens[at]
            at += 1
            left = (op, left, operand() if p == 3 else level(p + 1))
        return left

    return level(1)


def postfix_of(tree) -> list[str]:
    return [tree] if isinstance(tree, str) else postfix_of(tree[1]) + postfix_of(tree[2]) + [tree[0]]


def truth(tree, allowed) -> bool:
    if isinstance(tree, str):
        return tree in allowed
    if tree[0] == "with":
        return truth(tree[1], allowed) or f"{tree[1]} with {tree[2]}" in allowed
    both = truth(tree[1], allowed), truth(tree[2], allowed)
    return any(both) if tree[0] == "or" else all(both)


def random_expression(pick, depth=0) -> list[str]:
    kind = pick.random()
    if depth > 3 or kind < 0.35:
        name = pick.choice("abcd")
        return [name, "with", "x"] if pick.random() < 0.2 else [name]
    if kind < 0.5:
        return ["(", *random_expression(pick, depth + 1), ")"]
    return [*random_expression(pick, depth + 1), pick.choice(["and", "or"]), *random_expression(pick, depth + 1)]


def test_shunting_yard_against_recursive_descent():
    pick = random.Random(2)
    for _ in range(3000):
        tokens = random_expression(pick)
        postfix, used, valid = licences.to_postfix(tokens)
        tree = grammar(tokens)
        assert valid and used == len(tokens) and postfix == postfix_of(tree)
        allowed = frozenset(x for x in ["a", "b", "c", "d with x"] if pick.random() < 0.5)
        assert licences.evaluate(postfix, allowed) == truth(tree, allowed)
    for _ in range(3000):  # anything else is read as far as it goes and never breaks
        tokens = [pick.choice(["a", "b", "and", "or", "with", "(", ")"]) for _ in range(pick.randint(0, 9))]
        postfix, used, valid = licences.to_postfix(tokens)
        assert used <= len(tokens) and (not postfix or licences.evaluate(postfix, frozenset("a")) in (True, False))


def one(spark, text, **more):
    return licences.scan_licences(spark.createDataFrame([(1, text)], "doc_id long, text string"), **more).first()


def test_tags_and_joined_notices(spark):
    r = one(spark, "/* é SPDX-License-Identifier: (MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0 */")
    assert r["labels"] == ["apache-2", "gpl-2", "mit"] and r["score"] == 1.0 and r["permitted"]
    assert r["expressions"][0]["text"] == "(MIT OR GPL-2.0-only WITH Classpath-exception-2.0) AND Apache-2.0"
    assert r["expressions"][0]["postfix"] == ["mit", "gpl-2", "classpath-exception-2", "with", "or", "apache-2", "and"]
    r = one(spark, "Licensed under the GNU General Public License, version 3 or the Apache License, Version 2.0.")
    assert r["expressions"][0]["postfix"] == ["gpl-3", "apache-2", "or"] and r["permitted"]
    assert not one(spark, "GNU General Public License, version 3 and the Apache License, Version 2.0.")["permitted"]
    r = one(spark, "GNU General Public License, version 2 with Classpath exception")
    assert r["labels"] == ["gpl-2"] and not r["permitted"]
    assert one(spark, "GNU General Public License, version 2 with Classpath exception",
               allowed=frozenset(["gpl-2 with classpath-exception-2"]))["permitted"]
    for text in ["SPDX-License-Identifier: see the file", "the classpath exception", "a license expression is nice",
                 "license identifier: MIT"]:
        assert one(spark, text)["findings"] == [] and one(spark, text)["permitted"] is None
    broken = one(spark, "SPDX-License-Identifier: MIT OR (")
    assert broken["labels"] == ["mit"] and broken["score"] == licences.BROKEN_TAG and not broken["expressions"][0]["valid"]
    assert one(spark, "SPDX-License-Identifier: MIT. More text")["expressions"][0]["text"] == "MIT"


def test_license_odd_rows(spark, odd_documents, clashing, no_documents):
    rows = licences.scan_licences(clashing.withColumn("findings", F.lit("mine")).withColumn("_text_x", F.lit(1)))
    assert rows.count() == odd_documents.count() and len(rows.columns) == len(set(rows.columns))
    assert dict(rows.dtypes)["score"] == "double" and dict(rows.dtypes)["findings"].startswith("array")
    blank = rows.where("doc_id in (4, 5, 6)").collect()
    assert all(r["n_words"] == 0 and r["score"] == 0 and r["labels"] == [] for r in blank)
    assert licences.scan_licences(no_documents).count() == 0
    long = "word " * 300_000 + "under the MIT license " + "word " * 300_000 + "SPDX-License-Identifier: ISC " * 20_000
    r = one(spark, long)
    assert r["labels"] == ["isc", "mit"] and [f["word"] for f in r["findings"] if f["kind"] == "base"] == [300_000]


# --- periodic runs ------------------------------------------------------------------------

def brute_runs(w: list, least: int = 6) -> list[tuple[int, int, int]]:
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j - i + q >= max(least, 4 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((i, j - i, q) for (i, j), q in found.items())


def brute_row(words: list[str]) -> tuple:
    found = brute_runs(words)
    kept = [True] * len(words)
    for start, length, q in found:
        for i in range(start + q, start + length):
            kept[i] = False
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
    return (len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for x, k in zip(words, kept, strict=True) if k)))


def random_words(pick) -> list[int]:
    n, letters = pick.choice([0, 1, 5, 8, 20, 60, 200, 500]), pick.choice([1, 2, 3, 5, 50])
    out: list[int] = []
    while len(out) < n:
        if pick.random() < 0.4:
            unit = [pick.randrange(letters) for _ in range(pick.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 64, 65]))]
            if pick.random() < 0.3 and len(unit) > 4:
                unit = unit[:2] * pick.randrange(2, 9) + unit
            out += (unit * 10)[:pick.randrange(1, 9) * len(unit) + pick.randrange(len(unit))]
        else:
            out += [pick.randrange(letters) for _ in range(pick.randrange(6))]
    return out


def test_runs_of_random_sequences():
    pick = random.Random(1)
    n = 0
    for _ in range(150):
        docs = [random_words(pick) for _ in range(pick.randrange(1, 8))]
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        row, start, length, q = periods.find_runs(mix(np.array([x for d in docs for x in d], np.uint64) + np.uint64(9)), at)
        for r, d in enumerate(docs):
            own = row == r
            want = brute_runs(d)
            assert list(zip(start[own].tolist(), length[own].tolist(), q[own].tolist(), strict=True)) == want
            n += len(want)
    assert n > 1000


def test_thue_morse_and_fibonacci_words():
    """Sequences full of squares without any run of exponent 4, and long ones with one."""
    a, b = [0], [0, 1]
    for _ in range(12):
        a, b = a + [1 - x for x in a], b + b[:len(a)]
    morse = a
    for words, want in ((morse, []), (morse + morse + morse + morse, [(0, 4 * len(morse), len(morse))])):
        row, *rest = periods.find_runs(mix(np.array(words, np.uint64)), np.array([0, len(words)]))
        assert list(zip(*[c.tolist() for c in rest], strict=True)) == want
    fib = [0, 1]
    x, y = [0], [0, 1]
    while len(y) < 900:
        x, y = y, y + x
    fib = y
    row, *rest = periods.find_runs(mix(np.array(fib, np.uint64)), np.array([0, len(fib)]))
    assert list(zip(*[c.tolist() for c in rest], strict=True)) == brute_runs(fib)


def planted(doc_id, text) -> list[str]:
    w = SPACED.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_periodic_query_against_brute_force(spark, documents):
    want = {r["doc_id"]: brute_row(planted(r["doc_id"], r["text"])) for r in documents.collect()
            if len(r["text"] or "") < 12_000}
    rows = queries.QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == documents.count()
    for r in rows:
        if r["doc_id"] in want:
            assert tuple(r)[1:] == want[r["doc_id"]]
    assert sum(r["n_runs"] > 0 for r in rows) > 50


def test_periodic_odd_rows(spark, odd_documents, clashing, no_documents):
    rows = periods.collapse_runs(clashing.withColumn("runs", F.lit("mine")))
    assert rows.count() == odd_documents.count() and len(rows.columns) == len(set(rows.columns))
    texts = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    found = [(r["doc_id"], r["collapsed"], len(r["runs"])) for r in rows.collect()]
    want = []
    for doc_id, text in texts:
        w = SPACED.findall(text or "")
        runs_ = brute_runs(w[:3000]) if doc_id != 11 else [(0, len(w), 1)]
        kept = [x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs_)]
        want.append((doc_id, " ".join(kept), len(runs_)))
    assert sorted(map(str, found)) == sorted(map(str, want))
    assert periods.collapse_runs(no_documents).count() == 0
    long = spark.createDataFrame([(1, "a b c d e " * 200_000 + "end " + "x " * 100_000)], "doc_id long, text string")
    r = periods.collapse_runs(long).first()
    assert [tuple(x) for x in r["runs"]] == [(0, 1_000_000, 5), (1_000_001, 100_000, 1)]
    assert r["collapsed"] == "a b c d e end x"


@pytest.mark.parametrize("rows", [[], [(None, None)], [(None, "a a a a a a a"), (None, "a a a a a a a"), (7, "")]])
def test_scan_queries_on_small_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("op11_license_scan", "op13_periodic_runs"):
        assert queries.QUERIES[name](spark, str(tmp_path)).count() == len(rows)
