import datetime as dt

import pandas as pd

from cairn.streaming.attempts import Attempts, run_attempts

SCHEMA = "url string, id int, at timestamp, redirect boolean, answered boolean, found boolean, saved boolean"


def day(n, hour=0):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=hour)


def row(url, k, n, *, redirect=False, answered=True, found=False, saved=True):
    return (url, k, day(n), redirect, answered, found, saved)


def test_states_and_timers_over_runs(spark, tmp_path):
    src, out, state = (str(tmp_path / d) for d in ("in", "out", "state"))

    def run(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(src)
        run_attempts(spark.readStream.schema(SCHEMA).parquet(src), out, state, recheck_days=10, max_attempts=2).awaitTermination()
        return sorted((r.url, (r.at - day(0)).days, r.status, r.attempts) for r in spark.read.parquet(out).collect())

    first = run(row("a", 1, 0), row("b", 2, 0, saved=False), row("c", 3, 0, answered=False), row("d", 4, 0, redirect=True), row("e", 5, 1, found=True), row("e", 6, 2), row("f", 7, 0))
    assert first == [("a", 0, "requested", 1), ("b", 0, "not_archived", 0), ("c", 0, "not_archived", 0), ("d", 0, "unresolved_redirect", 0), ("e", 1, "archived", 0), ("f", 0, "requested", 1)]
    # too early for a; the timer of f announces it though nothing of its own comes
    second = run(row("a", 8, 5, found=True), row("c", 9, 12, saved=True), row("d", 10, 12))
    assert sorted(set(second) - set(first)) == [("a", 10, "due", 1), ("c", 12, "requested", 1), ("f", 10, "due", 1)]
    # a due address is asked for again, and given up after two requests; a lookup that comes with the day overtakes the timer
    third = run(row("a", 11, 13), row("f", 12, 13, saved=False), row("c", 13, 25, found=True))
    assert sorted(set(third) - set(second)) == [("a", 13, "requested", 2), ("a", 23, "due", 2), ("c", 22, "due", 1), ("c", 25, "archived", 1), ("f", 13, "requested", 1)]
    fourth = run(row("a", 14, 30), row("f", 15, 31, found=True))
    assert sorted(set(fourth) - set(third)) == [("a", 30, "failed", 2), ("f", 31, "archived", 1)]
    assert run(row("a", 16, 60), row("c", 17, 60)) == fourth


def test_equal_times_go_by_id_and_one_batch_overtakes_its_timers(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([row("a", 2, 0, found=True), row("a", 1, 0), row("a", 3, 10, found=True)], SCHEMA).write.parquet(src)
    run_attempts(spark.readStream.schema(SCHEMA).parquet(src), str(tmp_path / "out"), str(tmp_path / "state"), recheck_days=10, max_attempts=2).awaitTermination()
    assert sorted((r.at, r.status) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [(day(0), "requested"), (day(10), "archived"), (day(10), "due")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


class Handle:
    """A state store that counts visits."""

    def __init__(self):
        self.value, self.timers, self.visits = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        self.visits += 1
        return self.value

    def update(self, value):
        self.visits, self.value = self.visits + 1, value

    def registerTimer(self, at):
        assert at not in self.timers
        self.visits += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.visits += 1
        self.timers.remove(at)


class Passed:
    def __init__(self, at):
        self.getCurrentWatermarkInMs = self.getExpiryTimeInMs = lambda: at


def test_a_bucket_of_addresses_is_one_visit_to_the_store():
    handle, job = Handle(), Attempts(10, 2)
    job.init(handle)
    micros = lambda n: int(day(n).replace(tzinfo=dt.UTC).timestamp()) * 1_000_000
    frame = lambda rows: pd.DataFrame([(u, k, micros(n), False, True, found, True) for u, k, n, found in rows], columns=["url", "id", "at_us", "redirect", "answered", "found", "saved"])
    out = pd.concat(job.handleInputRows((0,), iter([frame([(f"u{k}", k, k % 4, False) for k in range(400)]), frame([(None, 400, 0, False)])]), None))
    assert len(out) == 401 and set(out["status"]) == {"requested"} and out["url"].isna().sum() == 1
    assert handle.visits <= 4 and handle.timers == {micros(10) // 1000}
    # two of four days have passed: their addresses are announced together, and the timer goes on to the next
    handle.timers.clear()
    due = pd.concat(job.handleExpiredTimer((0,), Passed(micros(11) // 1000), Passed(micros(10) // 1000)))
    assert len(due) == 201 and set(due["status"]) == {"due"} and sorted(set(due["at_us"])) == [micros(10), micros(11)]
    assert handle.timers == {micros(12) // 1000} and handle.visits <= 8
    # a lookup overtakes the timer of one address, a copy ends another; the rest stay as they were
    out = pd.concat(job.handleInputRows((0,), iter([frame([("u2", 500, 12, True), ("u1", 501, 12, True), ("u3", 502, 12, True)])]), None))
    assert sorted(zip(out["url"], out["status"])) == [("u1", "archived"), ("u2", "archived"), ("u2", "due")]
    assert handle.timers == {micros(12) // 1000} and len(handle.value[0]) == 401
