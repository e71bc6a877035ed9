"""License scans: one Aho-Corasick pass finds notices and identifier tags, a shunting-yard parser reads expressions.

The automaton runs over words, not characters: each word becomes one symbol
(0 where no phrase has it), so a slice of many texts is one symbol string and
a match gives its word number at once. Phrases of words are of four kinds:

- ``base``: the phrases of the contract; every place counts;
- ``notice`` and ``name``: further notice phrases and bare names; of those that
  overlap the leftmost longest stays;
- ``exception``: counts only behind a *with*;
- ``tag``: an identifier tag (``SPDX-License-Identifier:``), whose expression is
  read from the raw text behind it.

Expressions are identifiers joined by *or*, *and*, *with* (binding in this
order, the last the tightest) and parentheses. The shunting-yard parser turns
them into reverse Polish notation, which is evaluated against a policy of
allowed labels. Notices that stand next to each other with one of the three
words between them ("under the MIT license or the Apache License, Version 2.0")
are an expression as well.

Defined cases: null and empty texts have no words and no findings; texts are
read whole, however long, in time linear in their length; a text without
findings has score 0 and a null ``permitted``; a malformed expression is read
as far as it is one and marked not valid; findings that start together go by
length, then label; repeated rows give repeated results; an empty table gives
no rows; input columns named like results are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlake.llm.kernels import ALNUM_WORDS, LOWER, runs, slices, without, word_hashes, words

#: The phrases and labels of the contract.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Further notice phrases, written as words.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2": "apache-2",
    "apache license 2 0": "apache-2",
    "redistribution and use in source and binary forms": "bsd",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license version 2 1": "lgpl-2.1",
    "gnu lesser general public license version 3": "lgpl-3",
    "gnu affero general public license version 3": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "mozilla public license 2 0": "mpl-2",
    "eclipse public license version 2": "epl-2",
    "boost software license version 1": "bsl-1",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution 4 0": "cc-by",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by 4 0": "cc-by",
}
#: Bare names: weaker evidence.
NAMES = {
    "the mit license": "mit",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "isc license": "isc",
}
EXCEPTIONS = {
    "classpath exception": "classpath-exception-2",
    "gcc runtime library exception": "gcc-exception-3.1",
    "llvm exceptions": "llvm-exception",
}
#: Identifier tags as words, and as they are written.
TAGS = {
    "spdx license identifier": b"spdx-license-identifier",
    "license expression": b"license-expression",
}
CONFIDENCE = {"tag": 1.0, "base": 0.9, "notice": 0.9, "name": 0.6, "exception": 0.3}
BROKEN_TAG = 0.5

#: Labels that the default policy lets pass.
ALLOWED = frozenset(["mit", "apache-2", "bsd", "bsd-2-clause", "bsd-3-clause", "isc", "cc0-1", "cc-by", "bsl-1", "zlib",
                     "unlicense", "0bsd"])
#: Identifiers without a digit or a hyphen.
PLAIN_IDS = frozenset(["mit", "isc", "zlib", "unlicense", "wtfpl", "ncsa", "postgresql", "curl", "ruby", "vim"])

PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_FILLER = frozenset([b"the", b"either", b"of", b"a", b"also", b"under", b"your", b"choice"])
_TOKEN = re.compile(rb"[ \t]*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+_:-]*)")
_COLON = re.compile(rb"[ \t]*[:=][ \t]*[\"']?")


def label_of(identifier: str) -> str | None:
    """The label of an identifier: small letters, no ``-only``/``-or-later``/``+``, no ``.0``; None if it is none."""
    name = identifier.lower()
    if name not in PLAIN_IDS and not re.search(r"[0-9-]", name):
        return None
    name = re.sub(r"(-only|-or-later|\+)$", "", name)
    name = re.sub(r"^(cc-by[a-z-]*?)-[0-9.]+$", r"\1", name)
    return re.sub(r"-([0-9]+)\.0$", r"-\1", name)


def to_postfix(tokens: list[str]) -> tuple[list[str], int, bool]:
    """Shunting-yard: (postfix, tokens used, valid). Reads as far as the tokens are an expression."""
    out: list[str] = []
    held: list[str] = []
    operand_next, valid, used = True, True, 0
    for token in tokens:
        if operand_next and token == "(":
            held.append(token)
        elif operand_next and token != ")" and token not in PRECEDENCE:
            out.append(token)
            operand_next = False
        elif not operand_next and token in PRECEDENCE:
            while held and held[-1] != "(" and PRECEDENCE[held[-1]] >= PRECEDENCE[token]:
                out.append(held.pop())
            held.append(token)
            operand_next = True
        elif not operand_next and token == ")" and "(" in held:
            while held[-1] != "(":
                out.append(held.pop())
            held.pop()
        else:
            valid = not operand_next and token not in (")", "(")
            break
        used += 1
    if operand_next:  # an operator without its right side, perhaps behind open parentheses
        valid = False
        while held and held[-1] == "(":
            held.pop()
        if held:
            held.pop()
    while held:
        top = held.pop()
        if top == "(":
            valid = False
        else:
            out.append(top)
    return out, used, valid and bool(out)


def evaluate(postfix: list[str], allowed: frozenset[str]) -> bool:
    """Whether the policy lets the expression pass; an exception grants more, so *with* keeps its left side's answer."""
    stack: list[tuple[bool, str]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append((token in allowed, token))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            name = f"{left[1]} with {right[1]}"
            stack.append((left[0] or name in allowed, name))
        else:
            stack.append((left[0] or right[0] if token == "or" else left[0] and right[0], ""))
    return stack[-1][0]


def licences_in(postfix: list[str]) -> list[str]:
    """The labels of an expression in order, without the exceptions behind *with*."""
    stack: list[list[str]] = []
    for token in postfix:
        if token not in PRECEDENCE:
            stack.append([token])
            continue
        right, left = stack.pop(), stack.pop()
        stack.append(left if token == "with" else left + right)
    return stack[-1] if stack else []


def _read_tag(raw: bytes, at: int) -> tuple[list[str], int, bool] | None:
    """The expression behind a tag that ends at byte ``at``: (postfix, end, valid)."""
    colon = _COLON.match(raw, at)
    if colon is None:
        return None
    pos, tokens, ends = colon.end(), [], []
    open_ = 0
    operand_next = True
    while (m := _TOKEN.match(raw, pos)) is not None:
        word = m.group(1)
        end = m.end()
        if word in (b"(", b")"):
            token = word.decode()
            if (token == "(") != operand_next or (token == ")" and not open_):
                break
            open_ += 1 if token == "(" else -1
        else:
            bare = word.rstrip(b".:_-")
            end -= len(word) - len(bare)
            token = bare.decode().lower()
            if token in PRECEDENCE:
                if operand_next:
                    break
                operand_next = True
            else:
                label = label_of(token)
                if not operand_next or label is None:
                    break
                token, operand_next = label, False
        tokens.append(token)
        ends.append(end)
        pos = end
        if len(word) > 1 and end < m.end():  # a full stop ends the expression
            break
    postfix, used, valid = to_postfix(tokens)
    if not postfix:
        return [], colon.end(), False
    return postfix, ends[used - 1], valid


class Scanner:
    """The automaton and the policy; built once in each task."""

    def __init__(self, allowed: frozenset[str] = ALLOWED):
        self.allowed = allowed
        groups = [("base", BASE), ("notice", NOTICES), ("name", NAMES), ("exception", EXCEPTIONS),
                  ("tag", dict.fromkeys(TAGS, ""))]
        vocabulary = sorted({w for _, phrases in groups for p in phrases for w in p.split()})
        raw = [w.encode() for w in vocabulary]
        ends = np.cumsum([len(w) for w in raw])
        hashes, _ = word_hashes(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], ends]), ALNUM_WORDS)
        order = np.argsort(hashes)
        self.hashes, self.symbols = hashes[order], (order + 1).astype(np.uint8)
        symbol = {w: chr(i + 1) for i, w in enumerate(vocabulary)}
        self.automaton = ahocorasick.Automaton()
        by_phrase: dict[str, list[tuple[str, str]]] = {}
        for kind, phrases in groups:
            for phrase, label in phrases.items():
                by_phrase.setdefault(phrase, []).append((kind, label))
        for phrase, meant in by_phrase.items():
            self.automaton.add_word("".join(symbol[w] for w in phrase.split()), (phrase.split(), meant))
        self.automaton.make_automaton()

    def matches(self, data: np.ndarray, offsets: np.ndarray):
        """Words of all rows, and {row: [(word, n_words, kind, label)]} with words counted from 0 in the row."""
        starts, ends, row = words(data, offsets, ALNUM_WORDS)
        at = runs(row, len(offsets) - 1)
        found: dict[int, list[tuple[int, int, str, str]]] = {}
        if len(starts):
            h, _ = word_hashes(data, offsets, ALNUM_WORDS)
            place = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            text = np.where(self.hashes[place] == h, self.symbols[place], 0).astype(np.uint8).tobytes().decode("latin-1")
            for last, (phrase, meant) in self.automaton.iter(text):
                first = last - len(phrase) + 1
                r = int(row[first])
                if row[last] != r or any(
                        LOWER[data[starts[first + i]:ends[first + i]]].tobytes() != w.encode() for i, w in enumerate(phrase)):
                    continue
                found.setdefault(r, []).extend((first - int(at[r]), len(phrase), *m) for m in meant)
        return starts, ends, at, found

    def scan(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, dict[int, dict]]:
        """Word counts of all rows, and the findings of those that have any."""
        starts, ends, at, found = self.matches(data, offsets)
        out = {}
        for r, own in found.items():
            lo = int(offsets[r])
            result = self._row(data[lo:int(offsets[r + 1])], starts[at[r]:at[r + 1]] - lo, ends[at[r]:at[r + 1]] - lo, own)
            if result is not None:
                out[r] = result
        return np.diff(at), out

    def _row(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, own: list) -> dict | None:
        raw = data.tobytes()
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        findings, expressions = [], []

        def finding(kind, label, first, n, confidence=None):
            findings.append({"label": label, "kind": kind, "word": first, "n_words": n,
                             "start": int(points[starts[first]]), "end": int(points[ends[first + n - 1]]),
                             "confidence": CONFIDENCE[kind] if confidence is None else confidence})

        def expression(kind, postfix, start, end, valid):
            expressions.append({"kind": kind, "text": raw[start:end].decode("utf-8", "replace"),
                                "start": int(points[start]), "end": int(points[end]), "postfix": postfix, "valid": valid,
                                "permitted": evaluate(postfix, self.allowed)})

        chosen: list[tuple[int, int, str, str]] = []  # leftmost longest of notices, names and exceptions
        for first, n, kind, label in sorted(own, key=lambda m: (m[0], -m[1], m[2] != "base", m[3])):
            if kind == "base":
                finding(kind, label, first, n)
            if kind == "tag":
                written = TAGS[b" ".join(LOWER[data[starts[i]:ends[i]]].tobytes() for i in range(first, first + n)).decode()]
                read = None
                if raw[starts[first]:ends[first + n - 1]].lower() == written:
                    read = _read_tag(raw, int(ends[first + n - 1]))
                if read is not None and read[0]:
                    postfix, end, valid = read
                    expression(kind, postfix, _COLON.match(raw, int(ends[first + n - 1])).end(), end, valid)
                    for label in dict.fromkeys(licences_in(postfix)):
                        finding(kind, label, first, n, None if valid else BROKEN_TAG)
            elif not chosen or first >= chosen[-1][0] + chosen[-1][1]:
                chosen.append((first, n, kind, label))

        chain: list = []

        def close():
            names = [c for c in chain if c[2] != "exception"]
            if len(chain) > 1 and names:
                tokens = [t for i, c in enumerate(chain) for t in ([c[4]] if i else []) + [c[3]]]
                postfix, _, valid = to_postfix(tokens)
                last = chain[-1]
                expression("notice", postfix, int(starts[chain[0][0]]), int(ends[last[0] + last[1] - 1]), valid)
            elif names:
                expression("notice", [names[0][3]], int(starts[names[0][0]]),
                           int(ends[names[0][0] + names[0][1] - 1]), True)
            chain.clear()

        for match in chosen:
            first, n, kind, label = match
            joined = self._joint(data, starts, ends, chain[-1], match) if chain else None
            if joined is None:
                close()
                if kind == "exception":
                    continue
            chain.append((*match, joined))
            if kind != "base":
                finding(kind, label, first, n)
        close()
        if not findings:
            return None
        findings.sort(key=lambda f: (f["word"], -f["n_words"], f["label"], f["kind"]))
        expressions.sort(key=lambda e: (e["start"], e["end"]))
        return {"findings": findings, "expressions": expressions,
                "labels": sorted({f["label"] for f in findings if f["kind"] != "exception"}),
                "permitted": all(e["permitted"] for e in expressions),
                "score": max(f["confidence"] for f in findings)}

    @staticmethod
    def _joint(data, starts, ends, before, match) -> str | None:
        """The operator between two neighbouring notices, if only filler words stand with it."""
        lo, hi = before[0] + before[1], match[0]
        if not 1 <= hi - lo <= 4:
            return None
        gap = [LOWER[data[starts[i]:ends[i]]].tobytes() for i in range(lo, hi)]
        # version numbers belong to the notice before: "version 2.0"
        operators = [g.decode() for g in gap if g.decode("utf-8", "replace") in PRECEDENCE]
        rest = [g for g in gap if g.decode("utf-8", "replace") not in PRECEDENCE and g not in _FILLER and not g.isdigit()]
        if len(operators) != 1 or rest or (operators[0] == "with") != (match[2] == "exception"):
            return None
        return operators[0]


FINDING = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("word", T.LongType()),
    T.StructField("n_words", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("confidence", T.DoubleType())])
EXPRESSION = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("text", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("postfix", T.ArrayType(T.StringType())),
    T.StructField("valid", T.BooleanType()), T.StructField("permitted", T.BooleanType())])
RESULTS = [T.StructField("n_words", T.LongType()), T.StructField("findings", T.ArrayType(FINDING)),
           T.StructField("expressions", T.ArrayType(EXPRESSION)), T.StructField("labels", T.ArrayType(T.StringType())),
           T.StructField("permitted", T.BooleanType()), T.StructField("score", T.DoubleType())]


def scan_licences(docs: DataFrame, allowed: frozenset[str] = ALLOWED, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (all by default), and for each row of ``text``:

    n_words; findings (label, kind, word, n_words, start, end, confidence; offsets in code points);
    expressions (text, start, end, postfix, valid, permitted); labels, distinct and sorted;
    permitted (whether ``allowed`` lets every expression pass); score (the strongest confidence).

    One pass without a shuffle.
    """
    names = [f.name for f in RESULTS]
    kept = without(docs if keep is None else docs.select(*keep), *names)
    source = docs.select(*[docs[c] for c in kept.columns], docs["text"].alias("_text_"))
    types = [to_arrow_type(f.dataType) for f in RESULTS]
    blank = {"findings": [], "expressions": [], "labels": [], "permitted": None, "score": 0.0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(allowed)
        for batch in batches:
            for rows, data, offsets in slices(batch, "_text_"):
                n_words, found = scanner.scan(data, offsets)
                each = [found.get(i, blank) for i in range(rows.num_rows)]
                columns = [pa.array(n_words, types[0])] + [
                    pa.array([e[n] for e in each], t) for n, t in zip(names[1:], types[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *columns], [*rows.schema.names[:-1], *names])

    return source.mapInArrow(run, T.StructType([*kept.schema.fields, *RESULTS]))
