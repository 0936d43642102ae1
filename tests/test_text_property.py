"""Text expressions against Python on generated text."""

from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from placemill import schemas as S
from placemill.constants import WHITESPACE
from placemill.functions import contains_token, split_list, strip_ws
from placemill.operators import parse_address

PIECES = st.text(alphabet=list(WHITESPACE) + list("ab,FLTX é〒😀​"), max_size=12)
CODES = {"FL": "Florida", "TX": "Texas", "AB": "Alberta"}
SLOW = settings(
    max_examples=5,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


@SLOW
@given(st.lists(PIECES, min_size=40, max_size=80))
def test_strip_split_and_membership(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    rows = df.select(
        "id",
        strip_ws("text").alias("stripped"),
        split_list("text").alias("parts"),
        contains_token("text", "a").alias("plain"),
        contains_token("text", "a", trim_tokens=True).alias("trimmed"),
    ).collect()
    for row in rows:
        text = texts[row.id]
        parts = text.split(",")
        assert row.stripped == text.strip()
        assert row.parts == parts
        assert row.plain == ("a" in parts)
        assert row.trimmed == ("a" in [part.strip() for part in parts])


def expected(address: str, containing: bool) -> tuple[str, str]:
    parts = address.split(",")
    if len(address) > 10 and len(parts) > 2:
        piece = parts[-1][1:3]
        for code, state in CODES.items():
            if piece in code if containing else piece == code:
                return parts[-2].strip(), state
    return "SIN DATO", "SIN DATO"


def test_addresses_match_a_plain_reading(spark):
    rng = random.Random(5)
    ends = ["FL 33601", " FL 1", " TX", " A", " ", "", " X9", "  FL", " BFL", " é", " L", " F"]
    towns = ["Tampa", " El Paso \t", "", "〒 Tokyo", "a.b", "(x"]
    streets = ["1 Main St", "Joe, 2 Main St", "x", "", "😀 Street 12345"]
    made = [
        ",".join([rng.choice(streets), rng.choice(towns) + rng.choice(["", ", Suite 4"])])
        + ("," + rng.choice(ends) if rng.random() < 0.9 else "")
        for _ in range(800)
    ]
    df = spark.createDataFrame(list(enumerate(made)), "id long, address string")
    dimension = [(f"{state} ", code, "") for code, state in CODES.items()]
    states = spark.createDataFrame(dimension, S.STATE_DIM).coalesce(1)
    found = set()
    for containing in (False, True):
        mode = "contains" if containing else "exact"
        for row in parse_address(df, states, mode=mode).collect():
            want = expected(made[row.id], containing)
            assert (row.city, row.state) == want, made[row.id]
            found.add(want[1])
    assert found == {"Florida", "Texas", "Alberta", "SIN DATO"}
