"""Eight half-decade throughput buckets."""

from __future__ import annotations

# Eight bucket centres 10^0, 10^0.5 ... 10^3.5 with edges a quarter
# decade to each side. The first bucket is reported as starting at 0, though values
# below its edge are in no bucket.
CENTRES = [i * 0.5 for i in range(8)]
EDGES = [(10.0 ** (x - 0.25), 10.0 ** (x + 0.25)) for x in CENTRES]


def in_bucket(value: str, bucket: int) -> str:
    """SQL condition: left-closed, right-open."""
    low, high = EDGES[bucket]
    return f"{value} >= {low!r}D AND {value} < {high!r}D"


def bucket_of(value: str) -> str:
    """SQL expression for the index of a value's bucket; NULL outside all of them."""
    cases = " ".join(f"WHEN {in_bucket(value, i)} THEN {i}" for i in range(len(EDGES)))
    return f"CASE {cases} END"
