"""The training-data operators against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import corpus_pipeline
from compare import connect, spark_rows, sql_rows
from placemill.llm import (
    decontaminate,
    langid,
    licenses,
    ordermin,
    packing,
    quality,
    repeats,
    sharding,
    shared,
    tokens,
    words,
)
from placemill.llm.components import components
from placemill.llm.license_texts import NOTICES
from placemill.llm.neardup import near_duplicates
from placemill.llm.queries import ORACLE, QUERIES
from placemill.llm.repeats import remove_repeats
from placemill.llm.tokens import count_tokens, encoder

FOLDER = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c "),
    (4, "one"),
    (5, "one"),
    (6, "Ünï 中文字符 “quoted” é. ½, x.,y <|endoftext|>b <|ENDOFTEXT|> don't ΣΑΣ. İI."),
    (7, "a b c d e f g h i j k l m n o p " * 300),
    (8, "a b c d e f g h i j k l m n o p " * 300),
    (None, "a b c d e f g h i j k l m n"),
    (9, "x" * 5000),
]


def table(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return df
    names = "bucket_no n_words n_removed digest n_tokens lang_pred score langid slot shard".split()
    return df.select("*", *[F.lit("own").alias(name) for name in names])


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


def repeats_by_hand(rows, window):
    seen, out = {}, {}
    for key, text in sorted(rows, key=lambda row: (row[0] is not None, row[0] or 0)):
        words = WORD.findall((text or "").encode())
        mark, new = [False] * len(words), []
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            if run in seen and seen[run] != key:
                mark[at : at + window] = [True] * window
            new.append(run)
        for run in new:
            seen.setdefault(run, key)
        kept = b" ".join(w for w, gone in zip(words, mark, strict=True) if not gone).decode()
        out[key] = (len(words), sum(mark), kept)
    return out


@pytest.mark.parametrize("window", [3, 13, 50])
def test_repeats(spark, window):
    rows = [tuple(row) for row in documents(spark).collect()] + [
        (10_000 + (key or 0), text) for key, text in ODD
    ]
    done = remove_repeats(table(spark, rows, extra=False), window=window).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in done} == repeats_by_hand(rows, window)


def test_repeats_of_odd_rows(spark):
    done = remove_repeats(table(spark, ODD)).collect()
    want = repeats_by_hand(ODD, 13)
    assert {r.doc_id: (r._n_words, r._n_removed, r.text) for r in done} == want
    assert all(r.n_words == r.bucket_no == "own" for r in done)
    assert remove_repeats(table(spark, [])).count() == 0


def shingles(text, size):
    words = WORD.findall((text or "").encode().lower())
    runs = {tuple(words[at : at + size]) for at in range(len(words) - size + 1)}
    return runs or ({tuple(words)} if words else set())


def groups_by_hand(rows, size):
    sets = {key: shingles(text, size) for key, text in rows if key is not None}
    up = {key: key for key in sets}

    def top(key):
        while up[key] != key:
            key = up[key]
        return key

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]) and top(a) != top(b):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {key: (len(sets[key]), top(key), top(key) == key) for key in keys}


def near_copies():
    draw = random.Random(5)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = []
    for key in range(60):
        words = list(base)
        for _ in range(key % 7):
            words[draw.randrange(120)] = f"n{draw.randrange(9999)}"
        rows.append((key, " ".join(words)))
    return rows


def test_near_duplicates(spark):
    rows = near_copies() + [(100 + (key or 50), text) for key, text in ODD]
    done = near_duplicates(table(spark, rows), shingle=4).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in done}
    assert got == groups_by_hand(rows, 4)
    assert len({top for _, top, _ in got.values()}) < len(rows)
    assert near_duplicates(table(spark, [])).count() == 0


def test_near_duplicates_whose_leaders_fit_none(spark):
    """The smallest ids are far from all others, so that only the rest finds the links."""
    draw = random.Random(8)
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = []
    for key in range(70):
        words_of_row = list(base)
        for at in draw.sample(range(120), 6 if key < 30 else key % 4):
            words_of_row[at] = f"n{draw.randrange(9999)}"
        rows.append((key, " ".join(words_of_row)))
    done = near_duplicates(table(spark, rows), shingle=4).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in done}
    want = groups_by_hand(rows, 4)
    assert got == want
    assert max(Counter(top for _, top, _ in want.values()).values()) > 30


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(at, at + 1) for at in range(40)]
    hub = [(100, 101 + at) for at in range(50)]
    edges = spark.createDataFrame(chain + hub + [(7, 7)], "u long, v long")
    got = {row.node: row.component for row in components(edges).collect()}
    assert got == {**{at: 0 for at in range(41)}, **{at: 100 for at in range(100, 151)}}


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(TOKENIZER)
    texts = [text for _, text in ODD] + ["J̌ J̌. ×. ÷, É. a\u0085b", "The the. THE,"]
    for text, ids in zip(texts, encoder(TOKENIZER)(pa.array(texts)), strict=True):
        assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_cache(spark, tmp_path, name):
    path, cache = public_tokenizers.path(name), str(tmp_path / "cache")
    df = table(spark, ODD)
    for times in (1, 2):
        done = count_tokens(df, path, cache).collect()
        want = {text or "": len(ids) for (_, text), ids in zip(ODD, encoder(path)(pa.array([t for _, t in ODD])), strict=True)}
        assert {r.text or "": r._n_tokens for r in done} == want
        assert len(done) == len(ODD)
        stored = spark.read.parquet(cache)
        assert stored.count() == stored.select("digest").distinct().count(), times
    assert count_tokens(table(spark, []), path, cache).count() == 0


def test_packing(spark):
    rows = [tuple(row) for row in documents(spark).collect()] + [(k, t) for k, t in ODD if k is None]
    got = packing.pack(table(spark, rows), TOKENIZER, keep_ids=True).collect()
    ids = dict(zip([k for k, _ in rows], encoder(TOKENIZER)(pa.array([t for _, t in rows])), strict=True))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for row in got:
        by_doc[row.doc_id].append(row)
        by_sequence[row.sequence_id].append(row)
    for key, pieces in by_doc.items():
        pieces.sort(key=lambda row: row.start)
        whole = [*ids[key].tolist(), 1]
        assert [one for row in pieces for one in row.ids] == whole
        assert {row.doc_tokens for row in pieces} == {len(whole)}
        for row in pieces:
            assert row.ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
            assert row.ids == whole[row.start : row.start + row.length]
    assert set(by_doc) == set(ids)
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda row: row.offset)
        total = 0
        for row in pieces:
            assert row.offset == total
            total += row.length
        padding += 2048 - total
        assert total <= 2048
    assert padding < 0.05 * sum(row.length for row in got)
    assert packing.pack(table(spark, []), TOKENIZER).count() == 0


class Held:
    """Stands for a DataFrame and holds the functions that its workers would run."""

    def __init__(self, spark):
        self.schema, self.runs = spark.createDataFrame([], "id long, text string").schema, []

    def mapInArrow(self, run, schema):  # noqa: N802
        self.runs.append(run)
        return self

    def select(self, *names):
        return self

    repartition = select


def test_workers_give_memory_back(spark, monkeypatch):
    texts = [(one, f"word{one} of{one} many {one}") for one in range(40)]
    rows = pa.table({"id": [key for key, _ in texts], "text": [text for _, text in texts]})
    backs, docs, encode = [], Held(spark), encoder(TOKENIZER)
    monkeypatch.setattr(packing, "give_back", lambda: backs.append(len(encode.codes)))
    shared.worker_memory()["of an earlier operator"] = 1
    packing.cut_pieces(docs, TOKENIZER, 1, 8, False)
    out = pa.Table.from_batches(docs.runs[0](iter(rows.to_batches(10))))
    assert set(out["id"].to_pylist()) == set(range(40))
    assert len(backs) == 4 and backs[-1] > 0
    assert shared.worker_memory() == {TOKENIZER: encode}  # what it learned stays

    items = decontaminate.read_items([(1, "word1 of1 many"), (2, "word2 or three")])
    docs = Held(spark)
    decontaminate._together(docs, items)
    found = pa.Table.from_batches(docs.runs[0](iter(rows.select(["text"]).to_batches(10))))
    assert found.num_rows and not shared.worker_memory()


def test_the_pipeline_sends_few_rows_to_python_at_a_time(spark, monkeypatch):
    before = spark.conf.get(corpus_pipeline.ARROW_ROWS)
    monkeypatch.setattr(corpus_pipeline, "BATCH_ROWS", 7)
    try:
        docs = table(spark, [(one, f"some words {one}") for one in range(40)], extra=False)
        corpus_pipeline.packing(spark, docs.coalesce(1), FOLDER)
        sizes = docs.coalesce(1).mapInArrow(
            lambda batches: (pa.record_batch([pa.array([len(one)])], ["n"]) for one in batches), "n long"
        )
        assert max(row.n for row in sizes.collect()) <= 7
        spark.conf.set(corpus_pipeline.ARROW_ROWS, "3")  # a smaller setting stays
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(corpus_pipeline.ARROW_ROWS) == "3"
    finally:
        spark.conf.set(corpus_pipeline.ARROW_ROWS, before)


def test_words_are_learned_a_few_at_a_time(monkeypatch):
    monkeypatch.setattr(tokens, "_LEARNED", 128)
    encode, most = tokens.WordEnds(TOKENIZER), []
    library = encode.tokenizer

    class Counted:
        def encode_batch(self, texts, **more):
            most.append(sum(len(text.split()) for text in texts))
            return library.encode_batch(texts, **more)

    encode.tokenizer = Counted()
    text = " ".join(f"{chr(97 + at % 26)}q{chr(97 + at // 26)}z {at}x a-{at}" for at in range(600))
    own = encode(pa.array([text, None, "ab. 1"]))
    for ids, one in zip(own, [text, "", "ab. 1"], strict=True):
        assert ids.tolist() == library.encode(one, add_special_tokens=False).ids
    assert len(most) > 10 and max(most) <= 128


def test_cutting_plan_places_every_item():
    draw = np.random.default_rng(3)
    histogram = Counter(draw.integers(1, 513, 3000).tolist())
    plan = packing.cutting_plan(dict(histogram), 512)
    placed: Counter = Counter()
    for pattern, times in plan:
        assert sum(size * count for size, count in pattern.items()) <= 512
        for size, count in pattern.items():
            placed[size] += count * times
    assert placed == histogram
    least = sum(size * count for size, count in histogram.items()) / 512
    assert sum(times for _, times in plan) <= 1.02 * least + 1


def test_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    done = langid.identify(docs, model).where(langid.held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in done) >= 0.97 * len(done)
    odd = {r.doc_id: r for r in langid.identify(table(spark, ODD), model).collect()}
    assert all(odd[key]._lang_pred == "und" and odd[key]._score == 0 for key in (1, 2, 3))
    assert all(0 <= r._score <= 1 and r.score == "own" for r in odd.values())
    none = langid.train(docs.limit(0))
    assert none.predict("text") == ("und", 0.0)


def test_a_word_kept_for_one_language_keeps_its_counts_in_others(spark, monkeypatch):
    monkeypatch.setattr(langid, "WORDS_PER_LANGUAGE", 2)
    rows = [(1, "x x x y y z", "a"), (2, "z z z z w w w", "b")]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {key for key in model.rows if key[0] == "w"} == {"wx", "wy", "wz", "ww"}
    a, b = np.exp(model.table[model.rows["wz"]]) * (np.array([6, 7]) + 500)
    assert round(a, 6) == 1.5 and round(b, 6) == 4.5


def test_lookup_table_is_balanced_and_stable(spark):
    names = [f"s{at}" for at in range(20)]
    full, less = sharding.lookup_table(names, 2003), sharding.lookup_table(names[:-1], 2003)
    assert max(Counter(full).values()) - min(Counter(full).values()) <= 1
    gone = sorted(names).index("s19")
    kept = [sorted(names)[at] for at in full]
    moved = sum(a != sorted(names[:-1])[b] for a, b in zip(kept, less, strict=True) if a != "s19")
    assert moved < 0.2 * 2003 and gone >= 0
    got = sharding.place(table(spark, ODD), names, size=2003).collect()
    assert len(got) == len(ODD) and all(r._shard == sorted(names)[full[r._slot]] for r in got)
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad)


def edit_sensitive(spark, left, right):
    df = ordermin.fingerprint(table(spark, [(1, left), (2, right)], extra=False))
    rows = {r.doc_id: r.fingerprint for r in df.collect()}
    pair = spark.createDataFrame([(rows[1], rows[2])], "a string, b string")
    return rows, pair.select(ordermin.likeness(F.col("a"), F.col("b"))).first()[0]


def test_order_fingerprints(spark):
    words = [f"w{at}" for at in range(400)]
    rows, same = edit_sensitive(spark, " ".join(words), " ".join(words))
    assert rows[1] == rows[2] and same == 1
    _, edited = edit_sensitive(spark, " ".join(words), " ".join(words[:-20] + ["new"] * 20))
    _, moved = edit_sensitive(spark, " ".join(words), " ".join(words[200:] + words[:200]))
    _, other = edit_sensitive(spark, " ".join(words), " ".join(f"o{w}" for w in words))
    assert other == 0 < moved < edited < 1
    done = ordermin.fingerprint(table(spark, ODD)).collect()
    prints = {r.doc_id: r.fingerprint for r in done}
    assert prints[1] == prints[2] == prints[3] and prints[7] == prints[8] != prints[9]


def test_order_fingerprints_of_texts_without_spaces(spark):
    draw = random.Random(9)
    chinese = "".join(chr(0x4E00 + draw.randrange(3000)) for _ in range(400))
    encoded = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(800))
    for text, new in ((chinese, "\u4e2d"), (encoded, "Z"), (chinese[:15], "\u4e2d")):
        _, same = edit_sensitive(spark, text, text[:3] + new + text[3:])
        _, other = edit_sensitive(spark, text, text[::-1])
        assert other < 0.3 < 0.5 < same


def test_order_query_against_python(spark, tmp_path):
    rows = [(key, text) for key, text in ODD if key is not None]
    table(spark, rows, extra=False).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op2_order_minhash"](spark, str(tmp_path)).collect()}
    texts = sorted(((k, t or "") for k, t in rows), reverse=True)
    for at, (key, text) in enumerate(texts):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + texts[(at + 1) % len(texts)][1][:cut]
        assert got[key].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[key].n_chars == len(text)


def test_licenses(spark):
    body = "lorem ipsum dolor " * 30
    mit = NOTICES["mit"].replace("free of charge", "free of any charge").upper()
    rows = [(1, body + NOTICES["apache-2.0"] + body), (2, "é " + body + mit), (3, body), *ODD[:4]]
    found = licenses.scan_licenses(table(spark, rows, extra=False), NOTICES).collect()
    texts = {1: rows[0][1], 2: rows[1][1]}
    best = {(r.doc_id, r.template): r for r in found if r.doc_id in (1, 2)}
    assert best[1, "apache-2.0"].coverage == 1 and 0.9 < best[2, "mit"].coverage <= 1
    hit = best[1, "apache-2.0"]
    assert texts[1][hit.begin : hit.end] == NOTICES["apache-2.0"].rstrip(".")
    assert texts[2][best[2, "mit"].begin :].startswith("PERMISSION")
    assert not [r for r in found if r.doc_id not in (1, 2)]


def test_licenses_with_a_changed_word_and_in_a_chain(spark):
    """Any one word of a five-word notice changed; a full notice after many of its first lines."""
    body, rows = "lorem ipsum dolor sit amet " * 8, []
    line = NOTICES["mit-line"].split()
    for at in range(len(line)):
        rows.append((at, body + " ".join([*line[:at], "other", *line[at + 1 :]]) + " " + body))
    repeated = "Licensed under the Apache License, Version 2.0.\n" * 200
    rows.append((9, body + repeated + NOTICES["apache-2.0"] + body))
    got = licenses.scan_licenses(table(spark, rows, extra=False), NOTICES).collect()
    assert {r.doc_id for r in got if r.template == "mit-line" and r.coverage == 0.8} == set(range(5))
    full = [r for r in got if r.template == "apache-2.0"]
    assert [(r.doc_id, r.coverage) for r in full] == [(9, 1.0)]
    assert rows[-1][1][full[0].begin : full[0].end] == NOTICES["apache-2.0"].rstrip(".")
    assert sum(r.template == "apache-2.0-line" for r in got) == 201


def test_every_registered_licence_is_found(spark):
    """Whole texts of MIT, BSD and ISC and notices of MPL, LGPL, AGPL and EPL among them."""
    names = sorted(NOTICES)
    wanted = "mit-full bsd-2-clause-full bsd-3-clause-full isc-full mpl-2.0 epl-2.0".split()
    wanted += "lgpl-2.1-or-later lgpl-3.0-or-later agpl-3.0-or-later".split()
    assert set(wanted) <= set(names)
    rows = [(at, f"lorem ipsum {NOTICES[name]} dolor sit") for at, name in enumerate(names)]
    got = licenses.scan_licenses(table(spark, rows, extra=False), NOTICES).collect()
    whole = {(r.doc_id, r.template) for r in got if r.coverage == 1}
    assert whole >= set(enumerate(names))


def test_groups_of_grams_are_alike():
    """Least grams are small numbers: by their size one group of 50 had a quarter of them."""
    draw = random.Random(7)
    texts = [" ".join(str(draw.randrange(10**6)) for _ in range(2000)) for _ in range(20)]
    docs = pa.table({"id": pa.array(range(20), pa.int64()), "t": pa.array(texts)})
    keys, *_ = repeats._grams_of(repeats._texts(docs, "id", "t", 50))
    sizes = np.bincount(repeats._share(keys, 50), minlength=50)
    assert len(keys) > 2000 and sizes.max() < 2.5 * sizes.mean()


def test_quality(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    own = quality.score_quality(docs, labels.where(~langid.held_out()))
    judged = own.join(labels.where(langid.held_out()), "doc_id").collect()
    assert sum(r.kept == (r.quality == 1) for r in judged) >= 0.95 * len(judged) > 0
    odd = table(spark, ODD).withColumn("source", F.lit(None)).withColumn("lang", F.lit("x"))
    got = quality.score_quality(odd, labels.limit(0)).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(odd.limit(0), labels).count() == 0


def test_a_sparse_site_stays_near_the_prior(spark):
    rows = [(at, "good text here", "big", "a") for at in range(50)] + [(99, "good text here", "small", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame(
        [(at, 1 if at < 40 else 0) for at in range(50)] + [(99, 0)], "doc_id long, quality int"
    )
    got = {r.doc_id: r for r in quality.score_quality(docs, labels).collect()}
    assert 0 < got[99].path_mean < got[0].path_mean


def test_quality_writes_few_files(spark, monkeypatch):
    """Each file starts processes beside the executor: the few rows of sites get few files."""
    written = []

    def counted(df, name):
        table = shared.stored(df, name)
        written.append((name, len(table.inputFiles())))
        return table

    monkeypatch.setattr(quality, "stored", counted)
    rows = [(at, f"text {at} here", f"host{at % 7}", f"path{at % 11}") for at in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(at, at % 2) for at in range(200)], "doc_id long, quality int")
    aqe = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(aqe, "false")
    try:
        done = quality.score_quality(docs, labels)
        assert done.count() == 300 == done.where("own is not null and path_mean is not null").count()
    finally:
        spark.conf.unset(aqe)
    assert sum(files for _, files in written) <= 9


def test_leaks(spark):
    benchmark = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    clean = [(key, text) for key, text in near_copies()[:20]]
    words = items[3].split()
    words[4] = words[9] = "changed"
    rows = clean + [(500, "before it " + items[0] + " after it"), (501, " ".join(words)), *ODD[:4]]
    df = table(spark, rows)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(df, benchmark).collect()}
    assert got == {(500, 0), (501, 3)}
    kept = decontaminate.without_leaks(df, benchmark)
    assert kept.columns == df.columns and kept.count() == len(rows) - 2
    assert decontaminate.find_leaks(df.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(df, benchmark.limit(0)).count() == 0


def leaks_by_hand(texts, items, answers):
    """(text, item) for every stretch of a text that holds enough of an item, in order."""
    out, limits = set(), decontaminate.Limits()
    for key, text in texts.items():
        present = set(text)
        for one, item in items.items():
            if sum(word in present for word in item) < limits.covered_with_answer * len(item):
                continue
            size = len(item) + len(item) // 4 + 4
            for at in range(max(1, len(text) - size + 1)):
                stretch = np.array(text[at : at + size])
                covered = decontaminate.common_subsequence(np.array(item), stretch) / len(item)
                if covered < limits.covered_with_answer:
                    continue
                own = answers[one]
                answered = decontaminate.common_subsequence(np.array(own), stretch) / len(own)
                if covered >= limits.covered or answered >= limits.answer:
                    out.add((key, one))
                    break
    return out


def test_leaks_of_more_items_than_dimensions(spark):
    """Every copy and paraphrase of 1,200 items, in short and long texts, as by brute force."""
    draw = random.Random(4)
    items, texts = {}, {}
    for one in range(1200):
        items[one] = [f"v{draw.randrange(4000)}" for _ in range(draw.randrange(12, 60))]
    for one in range(0, 1200, 3):
        kept = [w if draw.random() > one % 4 * 0.08 else f"n{draw.randrange(10**6)}" for w in items[one]]
        around = [f"v{draw.randrange(4000)}" for _ in range(draw.randrange(200))]
        cut = draw.randrange(len(around) + 1)
        texts[one] = around[:cut] + kept + around[cut:]
    docs = table(spark, [(key, " ".join(text)) for key, text in texts.items()], extra=False)
    rows = [(one, " ".join(item[:-5]) + ". " + " ".join(item[-5:])) for one, item in items.items()]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    want = leaks_by_hand(texts, items, {one: item[-5:] for one, item in items.items()})
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert len(want) >= 380 and got == want


def test_the_driver_gets_the_product_of_all_passages_once(spark, monkeypatch):
    """Summed over partitions in tasks: no whole matrix of each partition, no large row."""
    draw = random.Random(12)
    texts = [" ".join(f"v{draw.randrange(300)}" for _ in range(60)) for _ in range(200)]
    docs = spark.createDataFrame([(text,) for text in texts], "text string").repartition(3)
    items = decontaminate.read_items([(0, " ".join(f"v{at}" for at in range(300)))])
    together = decontaminate.stored(decontaminate._together(docs, items), "together")
    together = together.repartition(4, "range")
    right, local = np.random.default_rng(3).standard_normal((300, 20)), np.arange(301)
    kind, seen = type(together), []

    def watched(name, values):
        old = getattr(kind, name)

        def run(self, *args, **kwargs):
            out = old(self, *args, **kwargs)
            out = list(out) if name != "toArrow" else out
            seen.extend(len(value) for value in values(out) if isinstance(value, bytes | bytearray))
            return out

        monkeypatch.setattr(kind, name, run)

    watched("toLocalIterator", lambda rows: [value for row in rows for value in row])
    watched("collect", lambda rows: [value for row in rows for value in row])
    watched("toArrow", lambda table: [value for column in table.columns for value in column.to_pylist()])
    got = decontaminate._product(together, np.ones(300), local, right)
    monkeypatch.undo()
    column = pa.array(texts, pa.string())
    found = decontaminate._found(column)
    held = np.zeros((0, 300))
    for a, b, _ in zip(*decontaminate.passages(found.first), strict=True):
        row = np.zeros((1, 300))
        row[0, decontaminate._place(found.codes[a:b], items.vocabulary)] = 1
        held = np.r_[held, row]
    assert np.allclose(got, held.T @ (held @ right), rtol=1e-4, atol=1e-2)
    assert sum(seen) == got.nbytes and max(seen) <= decontaminate._RANGE * 20 * 8


def test_the_driver_gives_the_sent_model_back(spark, monkeypatch):
    docs = table(spark, [(1, "ein kleines haus"), (2, "a small house")], extra=False)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") == 1, "de").otherwise("en"))
    model, backs = langid.train(docs), []
    monkeypatch.setattr(langid, "give_back", lambda: backs.append(1))
    found = langid.identify(docs, model)
    assert backs == [1]
    assert {r.doc_id: r.lang_pred for r in found.collect()} == {1: "de", 2: "en"}


def test_the_latent_space_is_fitted_to_all_passages(spark, monkeypatch):
    """Words that stand together in some 4,000 documents, of up to 90 words: all count."""
    monkeypatch.setattr(decontaminate, "RANK", 6)
    monkeypatch.setattr(decontaminate, "ROUNDS", 12)
    monkeypatch.setattr(decontaminate, "_PAIRS", 100, raising=False)
    draw = random.Random(8)
    texts = [" ".join(f"v{draw.randrange(60)}" for _ in range(draw.randrange(90))) for _ in range(4000)]
    texts += ["v1 v2 v3 v4"] * 300 + [None, ""]
    items = decontaminate.read_items([(0, " ".join(f"v{at}" for at in range(60)))])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    benchmark = spark.createDataFrame([(0, " ".join(f"v{at}" for at in range(60)))], "i long, t string")
    (fitted,) = decontaminate._fitted(docs, benchmark, "text", "i", "t")
    column = pa.array(texts, pa.string())
    found = decontaminate._found(column)
    begin, end, _ = decontaminate.passages(found.first)
    held = np.zeros((len(begin), 60))
    for row, a, b in zip(held, begin, end, strict=True):
        row[decontaminate._place(found.codes[a:b], items.vocabulary)] = 1
    assert np.allclose(fitted.idf, np.log((len(held) + 2) / (held.sum(axis=0) + 1)) ** 2)
    root = fitted.idf**0.5
    own = fitted.matrix(np.array([0]), np.arange(61), 60)
    own *= 4 * np.sqrt((held * root).ravel() @ (held * root).ravel()) / np.linalg.norm(own)
    rows = np.concatenate([held * root, own])
    _, vectors = np.linalg.eigh(rows.T @ rows)
    basis = fitted.spaces[0].basis / root[:, None]
    # the best rank-6 space holds as much of the passages as the one that was fitted
    best, got = (np.square(rows @ side).sum() for side in (vectors[:, -6:], basis))
    assert abs(np.linalg.norm(basis) - 6**0.5) < 1e-3 and got >= best * (1 - 1e-5)


def test_leaks_of_common_words_in_a_large_corpus(spark):
    """Short items of words that keep their frequency, between words found nowhere else."""
    draw = random.Random(6)
    items = {one: [f"c{draw.randrange(200)}" for _ in range(15)] for one in range(40)}
    texts = {}
    for one, item in items.items():
        around = [f"n{one}x{at}" for at in range(300)]
        texts[one] = " ".join(around[:150] + item + around[150:])
    word = F.concat(F.lit("c"), F.pmod(F.xxhash64("id", "at"), F.lit(200)))
    filler = spark.range(1000, 21_000).withColumn("at", F.explode(F.sequence(F.lit(1), F.lit(20))))
    filler = filler.groupBy("id").agg(F.concat_ws(" ", F.collect_list(word)).alias("text"))
    docs = table(spark, list(texts.items()), extra=False).unionAll(filler)
    rows = [(one, " ".join(item)) for one, item in items.items()]
    benchmark = spark.createDataFrame(rows, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, benchmark).collect()}
    assert got >= {(one, one) for one in items}


def test_the_scan_reads_and_searches_little(monkeypatch):
    rng = np.random.default_rng(5)
    place = np.concatenate([np.arange(at, at + 40) for at in range(64)])
    row = np.repeat(np.arange(64), 40)
    basis, read = rng.standard_normal((300, 16)).astype(np.float32), []

    class Basis:
        def __len__(self):
            return len(basis)

        def __getitem__(self, words):
            read.append(len(words))
            return basis[words]

    sums = decontaminate._sums(Basis(), place, row, 64)
    for one in range(64):
        assert np.allclose(sums[one], basis[place[row == one]].sum(axis=0), atol=1e-4)
    assert read == [103]  # shared words once, not 64 * 40 rows

    vocabulary = np.sort(words.mix(np.arange(50, dtype=np.uint64) + np.uint64(1)))
    codes = words.mix(np.arange(20_000, dtype=np.uint64) + np.uint64(1))
    searched, search = [], np.searchsorted
    monkeypatch.setattr(
        np, "searchsorted", lambda a, v, *rest, **more: searched.append(np.size(v)) or search(a, v, *rest, **more)
    )
    at = decontaminate._place(codes, vocabulary)
    assert (at[:50] >= 0).all() and (vocabulary[at[:50]] == codes[:50]).all() and (at[50:] == -1).all()
    assert sum(searched) < 1000
    assert decontaminate._place(codes, vocabulary[:0]).tolist() == [-1] * len(codes)


def test_common_subsequence():
    draw = random.Random(2)
    for _ in range(30):
        a, b = ([draw.randrange(6) for _ in range(draw.randrange(1, 14))] for _ in range(2))
        grid = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                grid[i + 1][j + 1] = grid[i][j] + 1 if x == y else max(grid[i][j + 1], grid[i + 1][j])
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == grid[-1][-1]


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_with_sql(spark, key):
    want, names = sql_rows(connect(FOLDER), ORACLE[key])
    got = QUERIES[key](spark, FOLDER)
    assert sorted(got.columns) == names and spark_rows(got) == want


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before, held = {r.doc_id for r in docs.collect()}, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, FOLDER)
        assert sorted(done.columns) == sorted(docs.columns), name
        now = {r.doc_id for r in done.select("doc_id").collect()}
        assert now <= before
        docs, before, held = done, now, name
    assert held == "decontaminate" and 0.5 * 200 < len(before) < 200
    packed = corpus_pipeline.run(spark, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == before


def test_functions_sent_to_workers_stay_small():
    texts = pa.array(["one two", None])
    codes = words.words_of(texts).codes
    sent = cloudpickle.dumps(lambda column: words.words_of(column).codes)
    assert len(sent) < 100_000
    assert (cloudpickle.loads(sent)(texts) == codes).all()
