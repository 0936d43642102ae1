"""Token ids against the libraries, counts without moving texts, words and languages by hand."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from placemill.llm import langid, tokens
from placemill.llm.tokens import encoder, token_counts
from placemill.runtime import scratch_path

WORDS = public_tokenizers.path("word_bpe_49k.json")


def library(path, texts):
    if path.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        return SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return [row.ids for row in tokenizer.encode_batch(texts, add_special_tokens=False)]


def odd_texts(count, seed):
    draw = random.Random(seed)
    spans = [(0x41, 0x7B), (0xC0, 0x250), (0x300, 0x330), (0x370, 0x530), (0x1E00, 0x1E40), (0x4E00, 0x4E10)]
    letters = [chr(at) for span in spans for at in range(*span)]
    letters += list("İIıßΣσς.,.,.,'-<>|0123456789   \t\n“”…") + ["<|endoftext|>", "'s", "i̇", "①"]
    texts = ["BİLGİ.", "BİLGİ, x", "İ.", "ΣΑΣ.", "naïve., é.", ""]
    while len(texts) < count:
        pool = letters if draw.random() < 0.5 else [*draw.sample(letters, 12), ".", ",", " ", "İ"]
        texts.append("".join(draw.choice(pool) for _ in range(draw.choice([1, 2, 3, 5, 8, 20]))))
    return texts


@pytest.mark.parametrize(
    ("name", "count"),
    [("word_bpe_49k.json", 100_000), ("byte_bpe_50k.json", 5_000), ("piece_bpe_32k.model", 5_000)],
)
def test_ids_of_odd_texts(name, count):
    path, texts = public_tokenizers.path(name), odd_texts(count, 8)
    got = encoder(path)(pa.array(texts))
    assert [ids.tolist() for ids in got] == [list(ids) for ids in library(path, texts)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_ids_of_documents(spark, name):
    path = public_tokenizers.path(name)
    column = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").toArrow()
    texts = [text or "" for text in column.column(0).to_pylist()]
    got = encoder(path)(pa.array(texts))
    assert [ids.tolist() for ids in got] == [list(ids) for ids in library(path, texts)]


def test_letters_that_leave_a_point_alone():
    one = tokens.WordEnds(WORDS)
    assert all(one.parts[ord(letter)] for letter in "azAZéñßя")
    assert not any(one.parts[ord(letter)] for letter in "İ.1 ×÷'")


ROWS = [(1, "a b"), (2, "a  b"), (3, None), (4, ""), (None, "x " * 50), (5, "x " * 50), (5, "other"), (None, "lone")]


@pytest.mark.parametrize("bound", [tokens.MAX_KEYS, 0])
def test_counts_and_cache(spark, monkeypatch, bound):
    monkeypatch.setattr(tokens, "MAX_KEYS", bound)
    cache = scratch_path(spark, "cache")
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").select(
        "*", *[F.lit("own").alias(c) for c in ("digest", "row_key", "_spread", "n_tokens")]
    )
    want = sorted(
        (str(key), len((text or "").encode()), len(ids))
        for (key, text), ids in zip(ROWS, library(WORDS, [text or "" for _, text in ROWS]), strict=True)
    )
    for _ in range(2):
        done = token_counts(docs, WORDS, cache)
        assert done.columns == ["doc_id", "digest", "row_key", "_spread", "n_tokens", "n_bytes", "_n_tokens"]
        assert sorted((str(r.doc_id), r.n_bytes, r._n_tokens) for r in done.collect()) == want
        assert spark.read.parquet(cache).count() == 5  # "a b" and "a  b", null and "" are alike
    more = spark.createDataFrame([(9, "fresh words"), (10, "a b")], "doc_id long, text string")
    assert token_counts(more, WORDS, cache).count() == 2
    assert spark.read.parquet(cache).count() == 6
    assert token_counts(more.limit(0), WORDS, cache).count() == 0


def test_no_text_is_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    plan = token_counts(docs, WORDS, scratch_path(spark, "cache"))._jdf.queryExecution().toString()
    assert "text#" not in plan.split("== Physical Plan ==")[1]


# --- languages

TEXTS = {
    "①": [], "½ 12 -- _": [], "Ⅷ 5": [], "नमस्ते दुनिया": ["नमस्ते", "दुनिया"], "été x": ["été", "x"],
    "́abc": ["abc"], "don't": ["don", "t"], "a1b": ["a", "b"], "İSTANBUL": ["i̇stanbul"], "": [], "中文 字": ["中文", "字"],
}


@pytest.mark.parametrize("text", TEXTS)
def test_words(text):
    assert langid.words_in(text) == TEXTS[text]


def predicted_by_hand(model, text):
    words = langid.words_in(text)
    if not words:
        return "und", 0.0
    total = np.zeros(len(model.languages))
    for word in words:
        at = model.rows.get(f"w{word}")
        if at is not None:
            total += model.table[at]
            continue
        for size in range(langid.LONGEST_GRAM, 0, -1):
            known = [model.rows.get(f"{size}{gram}") for gram in langid.grams_of(word, size)]
            known = [at for at in known if at is not None]
            if known:
                total += model.table[known].mean(axis=0)
                break
    odds = np.exp(total - total.max())
    return model.languages[int(odds.argmax())], float(odds.max() / odds.sum())


def test_predictions_by_hand(spark):
    """Known words, back-off to every length, unknown letters, long and empty texts."""
    rows = [(1, "the cat sat on the mat", "en"), (2, "die katze sitzt auf der matte", "de")]
    rows += [(3, "le chat est assis sur la natte été", "fr"), (4, None, "en"), (5, "x", None), (6, "q", "und")]
    schema = "doc_id long, text string, lang string"
    model = langid.train(spark.createDataFrame(rows, schema))
    assert model.languages == ["de", "en", "fr"]
    draw = random.Random(9)
    texts = [None, *TEXTS, "the cat", "katzen", "assisent", "zzz", "the " * 20_000, "ж", "t", "catzen x été"]
    texts += ["".join(draw.choice("abcdehikstz éü.") for _ in range(40)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    df = df.select("*", *[F.lit("own").alias(c) for c in ("lang_pred", "score", "langid", "lang")])
    for row in langid.identify(df, model).collect():
        lang, score = predicted_by_hand(model, texts[row.doc_id])
        assert (row._lang_pred, row.lang_pred) == (lang, "own"), texts[row.doc_id]
        assert abs(row._score - score) < 1e-9
    assert langid.identify(df.limit(0), model).count() == 0


def test_a_model_takes_little_of_the_drivers_memory(spark):
    """Arrays for words and n-grams: Python objects for each took over 500 bytes an item."""
    draw = random.Random(4)
    texts = [" ".join("".join(draw.choices("abcdefgh", k=9)) for _ in range(10_000)) for _ in range(4)]
    rows = [(at, text, "ab"[at % 2]) for at, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        model = langid.train(docs)
        scorer = model.scorer()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    items = sum(len(own.codes) for own in scorer.items.values())
    assert items == len(model.table) > 40_000
    assert peak - (1 << 24) < 200 * items  # 16 MB: the powers of the codes, the classes of letters
