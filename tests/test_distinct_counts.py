import random

from cartwheel.operators import distinct_counts as dc

KEYS, IDS = ["day"], {"users": "user_id", "sessions": "session_id"}


def brute(lines):
    days = {d for d, u, s in lines if u is not None or s is not None}
    return sorted((d, len({u for e, u, _ in lines if e == d and u is not None}), len({s for e, _, s in lines if e == d and s is not None})) for d in days)


def test_changes_equal_a_rebuild(spark, rows):
    draw = random.Random(4)
    schema = "day int, user_id bigint, session_id string"

    def line():
        return (draw.randint(1, 4), draw.choice([None, 1, 2, 3]), f"s{draw.randint(0, 9)}")

    lines = [line() for _ in range(60)]
    state = dc.multiplicities(spark.createDataFrame(lines, schema), KEYS, IDS)
    for _ in range(3):
        gone = draw.sample(lines, 15)
        for one in gone:
            lines.remove(one)
        late = [line() for _ in range(10)]
        lines += late
        state = dc.changed(
            state,
            dc.multiplicities(spark.createDataFrame(gone, schema), KEYS, IDS, -1),
            dc.multiplicities(spark.createDataFrame(late, schema), KEYS, IDS),
        )
        assert rows(dc.distinct_counts(state, KEYS, list(IDS))) == brute(lines)


def test_groups_that_lose_all_rows_go(spark, rows):
    df = spark.createDataFrame([(1, 5, "a"), (2, None, None)], "day int, user_id bigint, session_id string")
    state = dc.multiplicities(df, KEYS, IDS)
    assert rows(dc.distinct_counts(state, KEYS, list(IDS))) == [(1, 1, 1)]
    assert dc.changed(state, dc.multiplicities(df, KEYS, IDS, -1)).count() == 0
