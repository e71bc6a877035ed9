"""Chat, mixing, tokens, language, personal data: results against brute force, and awkward rows."""

from __future__ import annotations

import base64
import hashlib
import itertools
import random
import re
import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm import chat, language, mixing, pii, token_counts

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


# --- chat ---------------------------------------------------------------------------------

TURNS = "conv_id long, turn int, role string, text string"


def test_chat_round_trip(spark):
    nasty = ["\\### Assistant: </turn> ok", "<|image:0|>", "</role>", "<", "\\", "\\</", "</turn></turn>", "", None,
             "<\\/turn>", "é\U0001f642\n", "<turn>", "$1 \\1", "<|"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] \
        + [(2, 0, None, "x"), (2, 0, "user", "tie b"), (2, 0, "user", "tie a"), (2, 0, "user", "tie a"),
           (None, 0, "</role>\n", "y"), (3, None, "assistant", None)]
    made = chat.format_conversations(spark.createDataFrame(rows, TURNS))
    back = {r["conv_id"]: r for r in chat.read_back(made).collect()}
    assert [(t["role"], t["text"]) for t in back[1]["turns"]] == [(r[2], r[3] or "") for r in rows[:len(nasty)]]
    assert back[1]["loss_texts"] == [r[3] or "" for r in rows[:len(nasty)] if r[2] == "assistant"]
    assert [t["text"] for t in back[2]["turns"]] == ["x", "tie a", "tie a", "tie b"]
    assert back[None]["turns"][0]["role"] == "</role>\n"
    assert back[3]["loss_texts"] == [""]
    for r in made.collect():  # spans are code points of the string itself
        for s in r["loss_spans"]:
            assert r["formatted"][s["start"]:s["end"]] + "</turn>" == r["formatted"][s["start"]:s["end"] + 7]


def test_chat_parts(spark):
    parts = ("array<struct<kind:string,text:string,ref:string,n_tokens:long>>")
    rows = [(1, 0, "user", None, [("text", "see </turn>", None, None), ("image", None, "s3://i", 576),
                                  ("audio", None, "a.wav", 30), ("text", " and ", None, None), ("document", None, "d.pdf", 7)]),
            (1, 1, "assistant", "plain", None), (2, 0, "user", "x", [])]
    made = {r["conv_id"]: r for r in chat.format_conversations(
        spark.createDataFrame(rows, TURNS + f", parts {parts}")).collect()}
    assert "see <\\/turn><|image:0|><|audio:1|> and <|document:2|></turn>" in made[1]["formatted"]
    assert [(a["turn"], a["kind"], a["ref"]) for a in made[1]["attachments"]] == [
        (1, "image", "s3://i"), (1, "audio", "a.wav"), (1, "document", "d.pdf")]
    assert made[1]["expanded_tokens"] == 613 and made[2]["expanded_tokens"] == 0
    assert chat.format_conversations(spark.createDataFrame([], TURNS)).count() == 0


# --- mixing -------------------------------------------------------------------------------

def test_poisson_counts_follow_the_rates(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("abcd").alias("text"),
                                      F.when(F.col("id") < 15_000, "big").otherwise("small").alias("source"))
    rows = mixing.mix_sources(docs, {"big": 1.0, "small": 3.0})
    n = {r["source"]: r["count"] for r in rows.groupBy("source").count().collect()}
    assert abs(n["big"] - 5000) < 300 and abs(n["small"] - 15_000) < 500
    per = rows.where("source = 'small'").groupBy("doc_id").count().toPandas()["count"]
    counts = np.concatenate([per, np.zeros(5000 - len(per))])
    assert abs(counts.var() / counts.mean() - 1) < 0.1  # Poisson: variance equals mean
    keys = [r["shuffle_key"] for r in rows.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    again = mixing.mix_sources(docs.repartition(7), {"big": 1.0, "small": 3.0})
    assert again.count() == rows.count() and again.exceptAll(rows).isEmpty()


def test_rows_without_an_id_draw_on_their_own(spark):
    """A third of all rows share one id or have none: their counts are Poisson as all others are."""
    docs = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("doc_id"),
        F.concat(F.lit("text "), F.col("id")).alias("text"), F.lit("one").alias("source"))
    rows = mixing.mix_sources(docs)
    n = rows.groupBy("text").count().groupBy("count").count().collect()
    kept = {r[0]: r[1] for r in n}
    for k, p in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert abs(kept[k] / 9000 - p) < 0.02
    for key in ("doc_id is null", "doc_id = 7"):
        some = rows.where(key)
        assert abs(some.count() - 3000) < 300 and some.select("shuffle_key").distinct().count() == some.count()


def test_mixing_large_rate(spark):
    docs = spark.createDataFrame([(i, "a" * 100, "big") for i in range(3000)] + [(9999, "a", "one")],
                                 "doc_id long, text string, source string")
    n = mixing.mix_sources(docs, {"big": 1.0, "one": 1.0}).where("doc_id = 9999").count()
    assert abs(n - 150_000) < 2000  # the one document has to give half of 300,001 characters


def test_mixing_odd_rows(odd_documents, no_documents, clashing):
    out = mixing.mix_sources(clashing)
    assert out.columns[:5] == odd_documents.columns and out.columns[-2:] == ["replica", "shuffle_key"]
    assert len(out.columns) == len(set(out.columns))
    assert {r["source"] for r in out.select("source").distinct().collect()} <= {"a", "b", "c", None}
    assert mixing.mix_sources(no_documents).count() == 0
    with pytest.raises(ValueError):
        mixing.mix_sources(odd_documents, {})


# --- tokens -------------------------------------------------------------------------------

PIECES = ["a", "the", " ", "  ", "\n", "'ll", "'r", "'", "é", "日本", "x", "\U0001f642", "<|endoftext|>", "<|end", "!!",
          "123", " and", "\t", "\x85", "\u180e", "\x1c", "\u200b", "\xa0", "ß", "'s", "²", "Ⅷ", "\r\n", "-"]


def test_every_prefix_and_budget_against_the_library():
    library = Tokenizer.from_file(VOCABULARY)
    counter = token_counts.PrefixCounter(open(VOCABULARY, "rb").read())
    pick = random.Random(3)
    for _ in range(300):
        text = "".join(pick.choice(PIECES) for _ in range(pick.randint(0, 12)))
        want = [len(library.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == want, text
        for budget in range(want[-1]):
            assert counter.longest_prefix(*counter.pieces(text), budget) == max(
                p for p, n in enumerate(want) if n <= budget), (text, budget)


def test_token_counts_of_tables(documents, clashing, no_documents):
    library = Tokenizer.from_file(VOCABULARY)
    for docs in (documents, clashing):
        rows = token_counts.count_tokens(docs, VOCABULARY).collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (
                len((r["text"] or "").encode()), len(ids), len(ids) > 512)
    assert token_counts.count_tokens(no_documents, VOCABULARY).count() == 0


# --- language -----------------------------------------------------------------------------

def test_language_held_out_accuracy(documents):
    model = language.fit(documents)
    rows = language.identify(documents, model).withColumn("held_out", language.held_out(F.col("doc_id")))
    right, n, rejected = rows.where("held_out").agg(
        F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.sum(F.col("rejected").cast("int"))).first()
    assert right / n >= 0.99 and rejected / n <= 0.01
    wild = documents.sparkSession.createDataFrame(
        [(1, "Съешь ещё этих мягких французских булок да выпей чаю " * 20), (2, "日本語の文章です。" * 30)], "doc_id long, text string")
    assert all(r["rejected"] for r in language.identify(wild, model).collect())


def test_language_rejects_what_it_did_not_learn(documents):
    """Unlearned languages in Latin script, random letters and encoded bytes go; a learned one stays."""
    pick = random.Random(7)
    texts = {
        "letters": " ".join("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 9))) for _ in range(200)),
        "few": " ".join("".join(pick.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(pick.randint(2, 9))) for _ in range(20)),
        "base64": base64.b64encode(pick.randbytes(900)).decode(),
        "it": "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e "
              "devono agire gli uni verso gli altri in spirito di fratellanza. " * 3,
        "pl": "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i "
              "sumieniem i powinni postępować wobec innych w duchu braterstwa. " * 3,
        "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. " * 3}
    rows = documents.sparkSession.createDataFrame([(i, t) for i, t in enumerate(texts.values())], "doc_id long, text string")
    model = language.fit(documents)
    kept = language.identify(rows, model).where("not rejected").collect()
    assert not kept, [list(texts)[r["doc_id"]] for r in kept]


def test_language_against_plain_nearest_centroid(documents):
    """Prediction, score and rejection by dictionaries of grams instead of matrices."""
    model = language.fit(documents)
    rows = language.identify(documents.limit(60), model).collect()
    for r in rows:
        counts = language.gram_counts([r["text"] or ""])[0]
        weights = {i: (c ** 0.5) * float(model.idf[i]) for i, c in enumerate(counts.tolist()) if c}
        norm = sum(w * w for w in weights.values()) ** 0.5
        cosines = [sum(w * float(centre[i]) for i, w in weights.items()) / norm if norm else 0.0 for centre in model.centre]
        best = max(range(len(cosines)), key=lambda j: cosines[j])
        if not norm:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        assert r["lang_pred"] == model.langs[model.owner[best]] and abs(r["score"] - min(cosines[best], 1)) < 1e-4
        reach = min(1.0, sum(counts.tolist()) / language.SHORT) ** 0.5
        assert r["rejected"] == (cosines[best] < model.bound[best] * reach)


def test_language_stage_without_labels_keeps_what_has_letters(spark, odd_documents):
    import corpus_pipeline
    blank = odd_documents.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language_id(spark, blank, "unused")
    assert kept.columns == odd_documents.columns
    letters = [r for r in blank.collect() if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(map(str, kept.collect())) == sorted(map(str, letters))


def test_language_odd_rows(documents, odd_documents, clashing, no_documents):
    model = language.fit(documents)
    rows = language.identify(clashing, model).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
        assert letters or (r["rejected"] and r["score"] == 0)
    assert language.identify(no_documents, model).count() == 0
    blank = language.fit(no_documents)
    assert {r["lang_pred"] for r in language.identify(odd_documents, blank).collect()} == {"und"}


# --- personal data ------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text: str) -> list[tuple[int, int, int]]:
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == 1 and any(int(p) > 255 for p in m.group().split("."))) \
                    or (kind == 2 and not (16 <= len(d) <= 19 and pii.luhn(d))) or (kind == 3 and not 8 <= len(d) <= 15):
                continue
            out.append((kind, *m.span()))
    return out


def test_base_spans_against_patterns():
    pick = random.Random(1)
    letters = list("ab1234567890@@..-+ ()é%") + ["1.2.3.4", "4539578763621486", "a@b.c", "+1 (988) 555-2485"]
    for _ in range(20_000):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 30)))
        assert pii.base_spans(text) == brute_spans(text), text


def test_field_adds_what_patterns_miss(documents):
    field = pii.train(documents)
    text = "call +1 (826) 555-4081 190.137.223.204 now, or 4539578763621486 4539578763621486 there"
    (base, added), = pii.find_spans([text], field)
    assert [text[s:e] for _, s, e in base] == ["190.137.223.204"]
    assert {text[s:e] for _, s, e in added} >= {"+1 (826) 555-4081"}
    assert not set(base) & set(added)
    clean = "In 2019 some 1,234 people paid 99.95 for 3 of 1000000 items (see 10.2.3)"
    assert pii.find_spans([clean], field) == [([], [])]


def brute_marginals(node, edges):
    """Label probabilities by summing over every labelling."""
    n, k = node.shape
    total = np.zeros((n, k))
    for labels in itertools.product(range(k), repeat=n):
        score = np.exp(sum(node[i, a] for i, a in enumerate(labels))
                       + sum(pair[labels[u], labels[v]] for u, v, pair in edges))
        for i, a in enumerate(labels):
            total[i, a] += score
    return total / total.sum(axis=1, keepdims=True)


@pytest.mark.parametrize(("chain", "skip", "most"), [
    ([(0, 1), (1, 2)], [(0, 4), (3, 4)], 1e-3),             # a tree: exact
    ([], [(0, 5), (1, 5), (2, 5), (3, 5), (4, 5)], 1e-3),   # one hub: exact
    ([(0, 1), (1, 2), (2, 3)], [(0, 4), (3, 4)], 0.05),     # one loop
])
def test_messages_against_every_labelling(chain, skip, most):
    pick = np.random.default_rng(5)
    for _ in range(5):
        k, n = len(pii.LABELS), min(v for _, v in skip)
        field = pii.SkipChain(pick.normal(0, 1, (pii.N_SHAPES, k)), pick.normal(0, 0.7, (k, k)), pick.normal(0, 0.7, (k, k)))
        x = pick.integers(0, 2, (n, pii.N_SHAPES)).astype(float)
        node = np.concatenate([x @ field.shape, np.zeros((1, k))])
        edges = [(u, v, field.chain) for u, v in chain] + [(u, v, field.skip) for u, v in skip]
        got = field.marginals(x, np.array(chain, int).reshape(-1, 2), np.array(skip, int).reshape(-1, 2))
        assert np.abs(got - brute_marginals(node, edges)[:n]).max() < most


def test_links_between_spellings():
    def linked(text):
        (own,), _, _, skip, _, hubs = pii._graph([text])
        return own, [{own[i].text for i, _ in held} for held in hubs], skip

    own, hubs, skip = linked("4539 5787 6362 1486 then 4539578763621486")
    assert {own[i].text for i in skip[:, 0]} == {"4539", "5787", "6362", "1486", "4539578763621486"}
    _, hubs, _ = linked("+1 (988) 555-2485 or 988 555 2485 or 555 2485")
    assert {"555-2485", "555", "2485"} in hubs and {"(988)", "988"} in hubs
    assert linked("+44 20 79 46 09 58 twice +44 20 79 46 09 58")[1]
    assert linked("mail <Ann@Mail.example> or mailto:ann@mail.example")[1]
    assert not {"1486", "1487"} & set().union(*linked("4539 5787 6362 1486 then 4539 5787 6362 1487")[1])
    assert not linked("4539 5787 6362 1486 then 9539 5780 6361 1487")[1]
    assert not linked("one two 12 34 56, 78 90")[1]
    for text in ("12 " * 5000, "988 555 2485, " * 3000):  # linear in the text
        assert len(linked(text)[2]) <= 3 * sum(pii.TAILS) * 15_000


def test_field_finds_other_spellings(documents):
    field = pii.train(documents)
    card, phone = "4539 5787 6362 1486", "+44 20 79 46 09 58"
    texts = [f"Paid with {card}. Later: {phone} {card} as before.",
             "Ring +1 (988) 555-2485 today, or 988 555 2485, or 9885552485 at night",
             "Room 12 34 56 on 2024-11-02 costs 99.50 or 100 200 300 400 500", "", "988 555 2485"]
    got = pii.find_spans(texts, field)
    found = [[text[s:e] for _, s, e in added] for text, (_, added) in zip(texts, got, strict=True)]
    assert found == [[phone, card], ["988 555 2485", "9885552485"], [], [], []]
    assert got == [pii.find_spans([text], field)[0] for text in texts]  # whatever shares the batch
    far = "call +1 (988) 555-2485 " + "and 988 555 2485, then " * 400
    (base, added), = pii.find_spans([far], field)
    assert len(base) == 1 and len(added) == 400


def test_personal_data_rows(documents, clashing, no_documents):
    field = pii.train(documents)
    for docs in (documents, clashing):
        rows = pii.find_personal_data(docs, field).collect()
        assert len(rows) == docs.count()
        for r in rows:
            base = brute_spans(r["text"] or "")
            listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in base)
            assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == i for b in base) for i in range(4)]
            assert not base or set(listed.split(",")) <= set(r["spans"].split(","))
    assert pii.find_personal_data(no_documents, pii.train(no_documents)).count() == 0
    assert pii.redact("a b@c.d e", [(0, 2, 7)]) == "a [EMAIL] e"
    hidden = pii.find_personal_data(documents, field, redacted=True).where("n_email > 0").select("text").collect()
    assert hidden and not any("@mail" in r["text"] for r in hidden)


def test_subpackage_is_optional():
    """Nothing else imports the subpackage."""
    code = ("import sys; sys.modules['ledgerlake.llm'] = None\nimport ledgerlake.plans.catalog, ledgerlake.plans.catalog_io, "
            "ledgerlake.streaming.jobs\nassert not [m for m in sys.modules if m.startswith('ledgerlake.llm.')]")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=__file__.rsplit("/tests/", 1)[0])
