"""SQL of the operators whose checks need a CRC-32, which the SQL dialect lacks."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: What each byte does to the register of a CRC-32.
_TABLE = """crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(
        list_prepend(n, [0, 0, 0, 0, 0, 0, 0, 0]),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
)"""


def _crc(column: str) -> str:
    """The unsigned CRC-32 of a text column's UTF-8 bytes, beside ``crc``."""
    hexa = f"hex(encode({column}))"
    digit = "(instr('0123456789ABCDEF', substr({0}, {1}, 1)) - 1)"
    byte = f"16 * {digit.format(hexa, '2 * i - 1')} + {digit.format(hexa, '2 * i')}"
    data = f"list_transform(range(1, length({hexa}) // 2 + 1), lambda i: ({byte})::BIGINT)"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, {data}),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""


RESAMPLE = f"""
WITH {_TABLE},
texts AS (
    SELECT 's' AS side, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
    UNION ALL
    SELECT 't', NULL, regexp_extract_all({_LOWER.format("coalesce(text, '')")},
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
),
found AS (SELECT side, doc_id, unnest(w) AS word FROM texts),
buckets AS (
    SELECT word, {_crc("word")} % 10000 AS bucket
    FROM (SELECT DISTINCT word FROM found), crc
),
counts AS (
    SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t
    FROM found JOIN buckets USING (word) GROUP BY bucket
),
totals AS (SELECT sum(s)::DOUBLE AS ss, sum(t)::DOUBLE AS tt FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (ss + 10000) /
        ((s + 1)::DOUBLE * (tt + 10000))))::BIGINT AS gain
    FROM counts, totals
),
weights AS (
    SELECT doc_id, sum(gain)::BIGINT AS weight
    FROM found JOIN buckets USING (word) JOIN gains USING (bucket)
    WHERE side = 's' GROUP BY doc_id
),
scored AS (
    SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((list_reduce(
            list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i:
                (instr('0123456789abcdef', substr(sha256('2024:' || doc_id), i, 1)) - 1)::BIGINT)),
            lambda a, b: a * 16 + b) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM texts LEFT JOIN weights USING (doc_id) WHERE side = 's'
),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place,
        count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

ARCHIVES = """
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN later THEN last_id END AS refers_to
FROM (
    SELECT *, payload_bytes >= 1000 AND page_id < last_id AS later
    FROM (
        SELECT page_id, html, strlen(html) AS payload_bytes,
            max(page_id) OVER (PARTITION BY html) AS last_id
        FROM (SELECT page_id, coalesce(html, '') AS html FROM pages)
    )
)
"""

VARIANTS = f"""
WITH RECURSIVE {_TABLE},
runs AS (
    SELECT doc_id, run, count(*) AS n FROM (
        SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")},
            '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
    ) GROUP BY doc_id, run
),
hashed AS (SELECT run, n, {_crc("doc_id || ':' || run")} AS h FROM runs, crc),
typos AS (
    SELECT n, CASE WHEN h % 31 = 0
        THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
        ELSE run END AS word
    FROM hashed
),
words AS (
    SELECT word, sum(n)::BIGINT AS n FROM typos WHERE length(word) >= 7
    GROUP BY word HAVING sum(n) >= 2
),
holes AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
),
shorter AS (SELECT DISTINCT h.word AS a, w.word AS b FROM holes h JOIN words w ON h.rest = w.word),
near AS (
    SELECT a.word AS a, b.word AS b FROM holes a JOIN holes b USING (rest, i)
    WHERE a.word <> b.word
    UNION SELECT a, b FROM shorter UNION SELECT b, a FROM shorter
),
best AS (
    SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS b_n
    FROM near JOIN words ON words.word = b GROUP BY a
),
formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
        CASE WHEN b_n >= 10 * n THEN b END AS form, CASE WHEN b_n >= 10 * n THEN b_n END AS form_n
    FROM words LEFT JOIN best USING (word)
),
followed AS (
    SELECT word, form AS at FROM formed WHERE form IS NOT NULL
    UNION ALL
    SELECT f.word, g.form FROM followed f JOIN formed g ON g.word = f.at WHERE g.form IS NOT NULL
),
roots AS (
    SELECT f.word, f.at AS root FROM followed f JOIN formed g ON g.word = f.at
    WHERE g.form IS NULL
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n
FROM formed LEFT JOIN roots USING (word)
"""
