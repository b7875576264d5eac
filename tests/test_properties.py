"""Property tests: numeric coercion agrees with the reference's float() parse
on every plain or scientific literal, and rejects the documented rest."""

from hypothesis import given, settings
from hypothesis import strategies as st

from snapdeck.functions import safe_double

finite = st.floats(allow_nan=False, allow_infinity=False, width=64)


def as_texts(x: float) -> list[str]:
    return [repr(x), f"{x:.6e}", f"  {x:.3f} ", f"{x:.10g}", f"{abs(x):f}".rstrip("0")]


@settings(max_examples=40, deadline=None)
@given(st.lists(finite, min_size=1, max_size=20))
def test_safe_double_matches_float(spark, xs):
    texts = sorted({t for x in xs for t in as_texts(x) if t.strip() not in ("", ".")})
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {r[0]: r[1] for r in df.select("v", safe_double("v").alias("d")).collect()}
    for t in texts:
        assert got[t] == float(t), t


@settings(max_examples=20, deadline=None)
@given(st.lists(st.sampled_from(["nan", "NaN", "inf", "-inf", "Infinity", "1_000", "1.0d", "1.0f", "0x10", "1e", "--1", "1..2", "", "  ", "abc"]), min_size=1, max_size=8))
def test_safe_double_rejects(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert all(r[0] is None for r in df.select(safe_double("v")).collect())


def pair_rule(name):
    """The pair-name rule in plain Python: split on the first '-'."""
    if not name or "-" not in name:
        return (None, None)
    base, _, quote = name.partition("-")
    return (base or "UNKNOWN", quote or None)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="AB-_x ", max_size=8)), min_size=1, max_size=25))
def test_split_pair_matches_rule(spark, names):
    from snapdeck.functions import split_pair

    df = spark.createDataFrame([(n,) for n in names], "v string")
    b, q = split_pair("v")
    got = [tuple(r) for r in df.select(b, q).collect()]
    assert got == [pair_rule(n) for n in names]


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=300),
    st.integers(1, 7),
)
def test_ranking_matches_window(spark, rows, parts):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from snapdeck.operators.ranking import row_number_within

    data = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    order = [F.desc("v"), F.asc("id")]
    got = {r.id: r.rn for r in row_number_within(df, ["k"], order, num_partitions=parts).collect()}
    ref = {r.id: r.rn for r in df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order))).collect()}
    assert got == ref
