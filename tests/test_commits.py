from concurrent.futures import ThreadPoolExecutor

from toolgauge.sources import commits

SCHEMA = "x bigint"


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], SCHEMA)


def seen(spark, path):
    return sorted((r.commit, r.x) for r in commits.read(spark, path, "t", SCHEMA).collect())


def test_nothing_written_yet(spark, tmp_path):
    assert seen(spark, str(tmp_path / "none")) == []
    assert commits.commits(spark, str(tmp_path / "none")).collect() == []


def test_writers_at_the_same_time_and_repeated_ones(spark, tmp_path):
    path = str(tmp_path / "log")

    def write(i):
        return commits.append(spark, {"t": numbers(spark, i, i + 10)}, path, f"run {i}")

    with ThreadPoolExecutor(4) as pool:
        given = list(pool.map(write, range(4)))
    assert sorted(given) == [1, 2, 3, 4]
    assert write(2) == given[2]
    assert seen(spark, path) == sorted((given[i], x) for i in range(4) for x in (i, i + 10))


def test_the_same_token_twice_at_once_counts_once(spark, tmp_path):
    path = str(tmp_path / "log")
    with ThreadPoolExecutor(2) as pool:
        given = list(pool.map(lambda _: commits.append(spark, {"t": numbers(spark, 7)}, path, "one"), range(2)))
    assert [x for _, x in seen(spark, path)] == [7]
    assert commits.append(spark, {"t": numbers(spark, 8)}, path) > max(given)


def test_rows_of_a_writer_that_died_stay_unseen(spark, tmp_path):
    path = str(tmp_path / "log")
    numbers(spark, 1, 2).write.json(f"{path}/t/staged=dead")
    assert seen(spark, path) == []
    assert commits.append(spark, {"t": numbers(spark, 3)}, path) == 1
    assert seen(spark, path) == [(1, 3)]


def test_a_number_that_is_taken_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "log")
    commits.append(spark, {"t": numbers(spark, 1)}, path, "a")
    original = commits._files

    class Blind:
        """Files whose listing misses what others have published meanwhile."""

        def __init__(self, files):
            self.files = files

        def __getattr__(self, name):
            return (lambda *_: []) if name == "listStatus" else getattr(self.files, name)

    commits._files = lambda spark, path: (lambda place, files: (place, Blind(files)))(*original(spark, path))
    try:
        assert commits.append(spark, {"t": numbers(spark, 2)}, path, "b") == 2
    finally:
        commits._files = original
    assert seen(spark, path) == [(1, 1), (2, 2)]
