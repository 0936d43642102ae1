"""Resampling, archives and spelling variants against brute force, and their edge cases."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, spark_rows, sql_rows
from placemill.llm import variants, warc
from placemill.llm.checksums import crc32_spans
from placemill.llm.queries import ORACLE, QUERIES
from placemill.llm.resample import drawn_documents, least_reaching, resample
from placemill.runtime import scratch_path

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", ["op11_resampling", "op12_warc", "op13_spelling_variants"])
def test_query(spark, key):
    want, names = sql_rows(connect(FOLDER), ORACLE[key])
    df = QUERIES[key](spark, FOLDER)
    assert sorted(df.columns) == names
    assert spark_rows(df) == want


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_crc32_of_spans():
    draw = random.Random(3)
    data = bytes(draw.randrange(256) for _ in range(3000))
    starts = [draw.randrange(3000) for _ in range(400)]
    ends = [min(3000, at + draw.choice([0, 1, 5, 63, 64, 65, 900])) for at in starts]
    before = [draw.randrange(1 << 32) for _ in starts]
    raw = np.frombuffer(data, np.uint8)
    found = crc32_spans(raw, np.array(starts), np.array(ends), np.array(before, np.uint32))
    assert found.tolist() == [
        zlib.crc32(data[a:b], c) for a, b, c in zip(starts, ends, before, strict=True)
    ]
    assert len(crc32_spans(raw, np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


# --- resampling


def draw_by_hand(rows, target, longest, buckets, percent, least, seed):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        runs = [
            " ".join(words[at : at + size])
            for size in range(1, longest + 1)
            for at in range(len(words) - size + 1)
        ]
        return len(words), [zlib.crc32(run.encode()) % buckets for run in runs]

    all_of = [(key, *features(text)) for key, text in rows]
    s = Counter(b for _, _, found in all_of for b in found)
    t = Counter(b for text in target for b in features(text)[1])
    big_s, big_t = sum(s.values()) + buckets, sum(t.values()) + buckets

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * big_s / ((s[b] + 1.0) * big_t)))

    out = []
    for key, n_words, found in all_of:
        weight = sum(gain(b) for b in found)
        score = None
        if key is not None:
            h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(found), weight, score, None, n_words])
    pool = sorted(
        (row for row in out if row[0] is not None and row[5] >= least),
        key=lambda row: (-row[3], row[0]),
    )
    for place, row in enumerate(pool[: len(pool) * percent // 100]):
        row[4] = place + 1
    return Counter(tuple(row[:5]) for row in out)


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 50, 10), (3, 7, 50), (2, 1, 100)])
def test_resample(spark, longest, buckets, percent):
    draw = random.Random(longest)
    words = ["The", "the", "ß9", "x", "中文", "a-b", "Éa", "42", "é"]
    rows = [
        (at, " ".join(draw.choice(words) for _ in range(draw.randrange(40)))) for at in range(120)
    ]
    rows += [(200, None), (201, ""), (202, "-- \t--"), (None, "the x " * 30), (203, "中" * 70 + " x" * 25)]
    rows += [(300, "the x 42 " * 9)] * 3
    target = ["the x the x", None, "42 中文 Éa", ""]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", F.lit("own").alias("score"), F.lit(1).alias("id"), F.lit(2).alias("down")
    )
    aims = spark.createDataFrame([(t,) for t in target], "text string")
    options = {"percent": percent, "least_words": 5, "longest": longest, "buckets": buckets}
    got = resample(docs, aims, **options, seed=7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    want = draw_by_hand(rows, target, longest, buckets, percent, 5, 7)
    assert Counter(tuple(row) for row in got.collect()) == want
    drawn = {key[0] for key in want if key[4] is not None}
    kept = drawn_documents(docs, got)
    assert {row.doc_id for row in kept.collect()} == drawn
    assert kept.columns == docs.columns


def test_resample_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    aims = spark.createDataFrame([("a",)], "text string")
    assert resample(none, aims).count() == 0
    few = spark.createDataFrame([(1, "a " * 30), (2, "b")], "weight long, text string")
    done = resample(few, aims.limit(0), id_column="weight", percent=100).collect()
    assert {(row.weight, row.n_features, row["rank"]) for row in done} == {(1, 30, 1), (2, 1, None)}
    with pytest.raises(ValueError, match="whole number"):
        resample(few.withColumn("weight", F.lit("x")), aims, id_column="weight")


def test_ties_at_the_cutoff_go_to_the_smaller_id(spark):
    values = spark.range(1000).select(F.when(F.col("id") < 990, 5).otherwise(-3).alias("v"), "id")
    assert least_reaching(values, "v", 10) == (-3, 0)
    assert least_reaching(values, "v", 11) == (5, 10)
    assert least_reaching(values.where("v = 5"), "id", 1) == (0, 0)
    assert least_reaching(values, "id", 1000) == (999, 999)
    wide = spark.createDataFrame([(-(2**62),), (2**62,)], "v long")
    assert least_reaching(wide, "v", 2) == (2**62, 1)


# --- archives

PAGES = [
    (1, "http://a/ b\r\nc", "x" * 999),
    (2, "http://a/2", "x" * 999),
    (3, "http://a/3", "é" * 500),
    (4, None, "é" * 500),
    (9, "http://a/9", "é" * 500),
    (9, "http://a/9", "é" * 500),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (None, "http://a/7", "é" * 500),
    (None, "http://a/7", "z" * 1200),
    (10, "http://a/10", "\r\n\r\nWARC/1.1\r\n" * 100),
    (11, "http://a/11", "long text " * 400_000),
]


def pages(spark, rows=PAGES):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *[F.lit("own").alias(c) for c in ("digest", "size", "original", "_spread")])


def test_archives_round_trip(spark):
    folder = scratch_path(spark, "archives")
    manifest = warc.write_archives(pages(spark), folder, archive_bytes=3000)
    done = warc.read_archives(manifest).collect()
    held = [r for r in done if r.record_type != "warcinfo"]
    got = Counter((r.id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in held)
    want = Counter()
    for key, _, html in PAGES:
        body = (html or "").encode()
        later = html == "é" * 500 and key != 9
        want[
            None if key is None else str(key),
            "revisit" if later else "response",
            "9" if later else None,
            len(body),
            hashlib.sha1(body).hexdigest(),
        ] += 1
    assert got == want
    by_id = {r.id: r for r in held}
    assert bytes(by_id["11"].payload).decode() == PAGES[-1][2]
    assert by_id["1"].target_uri == "http://a/%20b%0D%0Ac"
    assert by_id["4"].target_uri is None
    assert sum(r.records for r in manifest.collect()) == len(PAGES)
    assert warc.archives_in(spark, folder).count() == manifest.count() > 1


def test_archives_are_members_that_other_readers_open(spark):
    manifest = warc.write_archives(pages(spark).coalesce(1), scratch_path(spark, "archives"))
    (row,) = manifest.collect()
    raw = open(row.path, "rb").read()
    starts = [r.offset for r in warc.read_archives(manifest).collect()]
    assert len(starts) == len(PAGES) + 1
    for begin, end in zip(starts, [*starts[1:], len(raw)], strict=True):
        text = gzip.decompress(raw[begin:end])
        head, _, rest = text.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n")
        assert rest[length:] == b"\r\n\r\n"


def member(fields, block, tail=b"\r\n\r\n"):
    head = b"WARC/1.1\r\n" + b"".join(b"%s: %s\r\n" % pair for pair in fields)
    return gzip.compress(head + b"\r\n" + block + tail)


def test_damage_is_found():
    good = warc.page_record("1", "http://a", b"some payload", None, "2024-01-01T00:00:00Z")

    def damage(raw):
        return [r["damage"] for r in warc.read_records(io.BytesIO(raw))]

    assert damage(good + good) == [None, None]
    assert damage(b"") == []
    assert "ends inside" in damage(good + good[:-9])[-1]
    assert "gzip" in damage(good + b"rubbish")[-1]
    plain = zlib.decompress(good, 31)
    for old, new, word in [
        (b"some payload", b"some paylaod", "digest"),
        (b"Content-Length: 12", b"Content-Length: 13", "block"),
        (b"WARC/1.1", b"WORC/1.1", "not a WARC"),
        (b"\r\n\r\n", b"\r\n \r\n", "head"),
    ]:
        assert old in plain
        assert word in damage(gzip.compress(plain.replace(old, new)))[0]
    short = [(b"WARC-Type", b"resource"), (b"Content-Length", b"9")]
    assert "shorter" in damage(member(short, b"abc", b""))[0]
    assert "record end" in damage(member(short, b"abcdefghij"))[0]
    assert "Content-Length" in damage(member(short[:1], b"abc"))[0]
    assert damage(member([(b"WARC-Type", b"resource"), (b"Content-Length", b"0")], b"")) == [None]


def test_a_member_is_read_in_pieces():
    body = bytes(random.Random(1).randrange(256) for _ in range(1000)) * 3000
    raw = warc.page_record("7", None, body, None, "2024-01-01T00:00:00Z")

    class Slow(io.BytesIO):
        most = 0

        def read(self, size=-1):
            assert 0 < size <= warc.CHUNK
            return super().read(min(size, 7919))

    (record,) = warc.read_records(Slow(raw))
    assert record["payload"] == body
    assert record["damage"] is None


def test_damaged_archives_raise_or_report(spark):
    manifest = warc.write_archives(pages(spark).limit(3).coalesce(1), scratch_path(spark, "bad"))
    path = manifest.first().path
    raw = open(path, "rb").read()
    with open(path, "wb") as file:
        file.write(raw[:-5])
    reported = warc.read_archives(manifest, strict=False).collect()
    assert [r.damage is None for r in reported] == [True] * 3 + [False]
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_archives(manifest).collect()


def test_no_pages(spark):
    manifest = warc.write_archives(pages(spark, []), scratch_path(spark, "none"))
    assert manifest.count() == 0
    assert warc.read_archives(manifest).count() == 0


# --- spelling variants


def variants_by_hand(rows, least_letters, least_n, times, every):
    counts = Counter()
    for key, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", lower(text)):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_n}
    holes, near = defaultdict(set), defaultdict(set)
    for word in words:
        for at in range(len(word)):
            holes[word[:at] + "*" + word[at + 1 :]].add(word)
            shorter = word[:at] + word[at + 1 :]
            if shorter in words:
                near[word].add(shorter)
                near[shorter].add(word)
    for group in holes.values():
        for word in group:
            near[word] |= group - {word}
    form = {}
    for word, n in words.items():
        best = min(near[word], key=lambda other: (-words[other], other), default=None)
        if best and words[best] >= times * n:
            form[word] = best
    out = set()
    for word, n in words.items():
        root = word
        while root in form:
            root = form[root]
        out.add((word, n, len(near[word]), form.get(word), words.get(form.get(word)), root))
    return out


def spelled(draw, count):
    rows = []
    for key in range(count):
        words = []
        for _ in range(60):
            word = "".join(draw.choice("abÀé") for _ in range(draw.randrange(3, 9)))
            words += [word.upper() if draw.random() < 0.1 else word] * draw.choice([1, 1, 2, 30])
        rows.append((key, " ".join(words)))
    return rows


@pytest.mark.parametrize("cell", [4096, 40])
def test_variants(spark, monkeypatch, cell):
    monkeypatch.setattr(variants, "CELL_WORDS", cell)
    rows = spelled(random.Random(2), 80)
    rows += [(900, None), (901, ""), (902, "12 -- ×÷ ÿÿÿÿÿÿÿ ÿÿÿÿÿÿÿ"), (None, "aaaabbbb aaaabbbb")]
    rows += [(903, "x" * 40_000 + " " + "x" * 40_000 + " " + "x" * 40_001 + " " + "x" * 40_001)]
    rows += [(904, "aaaaaaa " * 50)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("own").alias(c) for c in ("word", "n", "size", "cell", "form", "root")]
    )
    done = variants.spelling_variants(docs, least_letters=4, times=2, drop_every=5)
    got = {tuple(row) for row in done.select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == variants_by_hand(rows, 4, 2, 2, 5)
    assert any(row[3] and row[5] != row[3] for row in got), "no chain of forms"


def test_no_words(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert variants.spelling_variants(none).count() == 0
    rare = spark.createDataFrame([(1, "unique words without company")], "doc_id long, text string")
    assert variants.spelling_variants(rare).count() == 0


def test_upper_tree_reaches_every_near_word():
    draw = random.Random(4)
    letters = np.array(
        [[draw.choice(b"abcdefgh") for _ in range(9)] for _ in range(800)], np.uint8
    )
    tree, members = variants.grow(variants.letter_counts(letters), 20)
    assert sorted(np.concatenate(members).tolist()) == list(range(800))
    home = np.empty(800, int)
    for leaf, rows in enumerate(members):
        home[rows] = leaf
    for gap, other in ((0, letters.copy()), (1, letters[:, 1:]), (-1, np.c_[letters, letters[:, 0]])):
        if gap == 0:
            other[:, 3] = ord("z")
        reached = defaultdict(set)
        for leaf, rows in variants.reached(tree, variants.letter_counts(other), *variants.REACH[gap]):
            for row in rows.tolist():
                reached[row].add(leaf)
        assert all(home[row] in reached[row] for row in range(800))
        assert np.mean([len(found) for found in reached.values()]) < len(members)
