"""Runs over several days: what is compared, what waits, what ages out."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from braidwork.functions import crypto
from braidwork.plans import schemas
from braidwork.plans.config import Options, parse_segments
from braidwork.plans.run import dead_letters, results, run
from braidwork.sources import state

SEGMENTS = json.dumps(
    [
        {"_comment": "x", "name": "main", "aiMethod": "ai", "humanMethod": "submit", "segmentTypeMappings": [{"roots": ["tradelines"], "segmentType": "trade"}]},
        {
            "name": "authanddocreview", "aiMethod": "auth.ai", "humanMethod": "auth.human", "payloadFormat": "id_request",
            "humanSubTypes": [
                {"name": "authentication", "discriminatorField": "verifiedData", "docProofsField": "documentProofs", "docProofsLabel": "Authentication"},
                {"name": "docreview", "discriminatorField": "documentProofs", "negativeDiscriminatorField": "verifiedData", "isBase": True, "docProofsField": "documentProofs", "docProofsLabel": "Document_Review"},
            ],
        },
    ]
)
DAY = datetime(2026, 5, 1, 9)


class World:
    def __init__(self, spark, root, keys=None):
        self.spark, self.root, self.keys = spark, root, keys
        self.options = Options(f"{root}/ai", f"{root}/human", f"{root}/state", f"{root}/results", f"{root}/dead", f"{root}/checkpoint", parse_segments(SEGMENTS), image_path="img", soft_arrays={"tradelines.tradelineRequested.disputeCodes": "tradelines"})
        self.human([], "seed"), self.ai([], "seed")
        state.Checkpoint(spark, self.options.checkpoint).seed(DAY - timedelta(hours=1))

    def _write(self, rows, ddl, folder):
        df = self.spark.createDataFrame(rows, ddl.replace(" not null", ""))
        if self.keys is not None:
            df = crypto.encrypted(df, self.keys, "payload")
        df.write.mode("append").parquet(folder)

    def human(self, rows, _=None):
        self._write([("k", m, p if isinstance(p, str) else json.dumps(p), c, at) for m, p, c, at in rows], schemas.HUMAN_PAYLOADS, f"{self.root}/human")

    def ai(self, rows, _=None):
        self._write([("k", m, json.dumps(p), at) for m, p, at in rows], schemas.AI_PAYLOADS, f"{self.root}/ai")

    def run(self, at):
        self.last = run(self.spark, self.options, at, self.keys)
        rows = results(self.spark, self.options).where(F.col("run") == self.last.run)
        if self.keys is not None:
            rows = crypto.with_keys(rows, self.keys)
            for name in ("human_value", "ai_value"):
                rows = rows.withColumn(name, crypto.decrypt(F.col(name), F.col("dek")))
        return rows.collect()

    def pending(self):
        return state.read_version(self.spark, f"{self.options.state}/pending", self.last.version, schemas.PENDING).collect()

    def pool(self):
        return state.read_version(self.spark, f"{self.options.state}/pool", self.last.version, schemas.AI_PENDING).collect()


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, str(tmp_path))


def test_compare_then_quiet_then_new_case_then_age(world):
    doc = {"img": " IMG1 ", "name": "Ann", "amount": 1.00, "tradelines": [{"accountNumber": "A", "customerNumber": "1", "dateOpened": "d", "balance": 5, "tradelineRequested": {"disputeCodes": [{"code": "007"}, {"code": "1"}]}}]}
    world.human([("submit", doc, "c1", DAY - timedelta(minutes=50))])
    other = json.loads(json.dumps(doc)) | {"name": "ANN", "amount": 1}
    other["tradelines"][0]["tradelineRequested"]["disputeCodes"] = [{"code": "005"}, {"code": "1"}, {"code": "9"}]
    world.ai([("ai", other, DAY - timedelta(minutes=40)), ("ai", {"img": "img1", "old": True}, DAY - timedelta(minutes=45)), ("nobody", {"img": "img1"}, DAY - timedelta(minutes=5))])
    rows = {(r.field_name, r.array_key): r for r in world.run(DAY)}
    assert rows["name", None].is_match and rows["name", None].case_id == "c1"
    assert not rows["amount", None].is_match and rows["amount", None].human_value == "1.0"
    code = "tradelines.tradelineRequested.disputeCodes.code"
    got = {k for f, k in rows if f == code}
    assert got == {"a-1-d-1-1", "a-1-d-005-007", "a-1-d-9-XXX"}
    assert rows[code, "a-1-d-9-XXX"].human_value is None and rows["tradelines.balance", "a-1-d"].segment_type == "trade"
    assert {r.ai_iteration for r in rows.values()} == {1} and len(world.pool()) == 2
    # the latest AI payload is the second one discovered, one second behind the first
    times = sorted(r.created_at for r in world.pool())
    assert times[1] - times[0] == timedelta(seconds=1)
    # nothing new: no rows, same version
    assert world.run(DAY + timedelta(hours=1)) == [] and [r.comparison_version for r in world.pending()] == [1]
    # another case adds a field and wins a collision by its later time
    world.human([("submit", {"img": "img1", "name": "Eve", "extra": "x"}, "c2", DAY + timedelta(hours=1))])
    rows = {(r.field_name, r.array_key): r for r in world.run(DAY + timedelta(hours=2))}
    assert rows["name", None].human_value == "Eve" and rows["name", None].case_id == "c2" and rows["extra", None].case_id == "c2"
    assert rows["amount", None].case_id == "c1" and rows["amount", None].ai_iteration == 2
    (waiting,) = world.pending()
    assert waiting.merged_case_ids == "c1;c2" and waiting.case_id == "c2" and waiting.comparison_version == 2
    # seven days on everything ages out; the human source keeps the rows in its lookback, so they are seen anew later
    world.options = Options(**{**world.options.__dict__, "human_lookback_days": 1})
    assert world.run(DAY + timedelta(days=7, hours=3)) == []
    assert world.pending() == [] and world.pool() == []
    dead = dead_letters(world.spark, world.options).groupBy("pending_type").count().collect()
    assert {r.pending_type: r["count"] for r in dead} == {"human": 1, "ai": 2}


def test_parts_wait_for_each_other(world):
    world.human([("auth.human", 'id="x",request="{\\"img\\":\\"i2\\",\\"verifiedData\\":{\\"a\\":1},\\"documentProofs\\":[{\\"document\\":\\"d1\\"}]}"', None, DAY - timedelta(minutes=30))])
    world.ai([("auth.ai", {"img": "i2", "verifiedData": {"a": 1}, "documentProofs": [{"document": "d1", "authenticationType": "Authentication"}]}, DAY - timedelta(minutes=20))])
    assert world.run(DAY) == [] and [r.pending_type for r in world.pending()] == ["human:authentication"]
    world.human([("auth.human", 'id=y,request={"img":"i2","documentProofs":[{"document":"d2"},{"document":"d9","authenticationType":"Authentication"}]}', None, DAY + timedelta(minutes=30))])
    rows = {(r.field_name, r.array_key): r for r in world.run(DAY + timedelta(hours=1))}
    assert rows["verifiedData.a", None].is_match
    keys = {k: r.is_match for (f, k), r in rows.items() if f == "documentProofs.document"}
    assert keys == {"authentication-d1": True, "document_review-d2": False}
    assert [r.pending_type for r in world.pending()] == ["human:merged"]


def test_failed_run_repeats_its_window(world, monkeypatch):
    world.human([("submit", {"img": "a", "x": 1}, "c", DAY - timedelta(minutes=30))])
    world.ai([("ai", {"img": "a", "x": 2}, DAY - timedelta(minutes=30))])
    monkeypatch.setattr(state.Checkpoint, "advance", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        world.run(DAY)
    monkeypatch.undo()
    assert len(world.run(DAY + timedelta(hours=5))) == 2  # img and x, once
    assert world.last.window.current_stop == DAY
    assert results(world.spark, world.options).count() == 2 < world.spark.read.parquet(world.options.results).count()


def test_two_runs_at_once(world, monkeypatch):
    """One of two concurrent runs is refused, while the other one works; the results are there once."""
    from concurrent.futures import ThreadPoolExecutor
    from threading import Barrier

    world.human([("submit", {"img": "a", "x": 1}, "c", DAY - timedelta(minutes=30))])
    world.ai([("ai", {"img": "a", "x": 2}, DAY - timedelta(minutes=30))])
    together = Barrier(2)

    def one(_):
        together.wait()
        try:
            return run(world.spark, world.options, DAY)
        except state.Held:
            return None

    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(one, range(2)))
    assert sum(x is not None for x in got) == 1 and results(world.spark, world.options).count() == 2


def test_an_overtaken_run_is_never_seen(world, monkeypatch):
    """A driver that stood still past its lease: another one takes the window over, and readers see its rows alone."""
    world.human([("submit", {"img": "a", "x": 1}, "c", DAY - timedelta(minutes=30))])
    world.ai([("ai", {"img": "a", "x": 2}, DAY - timedelta(minutes=30))])
    append, seen = state.append_run, []

    def slow(df, folder, name, day, *more):
        wrote = append(df, folder, name, day, *more)
        if folder == world.options.results and not seen:
            monkeypatch.setattr(state, "append_run", append)
            seen.append(results(world.spark, world.options).count())  # between the write and the commit
            seen.append(run(world.spark, world.options, DAY + timedelta(hours=1)))
        return wrote

    monkeypatch.setattr(state, "append_run", slow)
    with pytest.raises(state.Fenced):
        run(world.spark, world.options, DAY, lease_seconds=0.0)
    assert seen[0] == 0 and seen[1].window.current_stop == DAY
    rows = results(world.spark, world.options).collect()
    assert len(rows) == 2 and {r.run for r in rows} == {seen[1].run}
    assert len(state.vacuum(state.Checkpoint(world.spark, world.options.checkpoint), world.options.results, timedelta(0))) == 1
    assert results(world.spark, world.options).count() == 2


def test_encrypted_tables(spark, tmp_path):
    keys = spark.createDataFrame([("k", bytes(range(32)))], "key_id string, dek binary")
    world = World(spark, str(tmp_path), keys)
    world.human([("submit", {"img": "a", "x": 1}, "c", DAY - timedelta(minutes=30))])
    world.ai([("ai", {"img": "a", "x": 2}, DAY - timedelta(minutes=30))])
    assert {(r.field_name, r.human_value, r.ai_value) for r in world.run(DAY)} == {("img", "a", "a"), ("x", "1", "2")}
    assert "img" not in world.pending()[0].payload
    assert world.run(DAY + timedelta(hours=1)) == []


def test_cases_of_one_image(world):
    """Several cases of an image: fields that only one has, collisions, arrays that unite and arrays that don't; and
    what a later run adds."""
    early, late = DAY - timedelta(minutes=50), DAY - timedelta(minutes=30)
    line = lambda account, code="1": {"accountNumber": account, "customerNumber": "1", "dateOpened": "d", "tradelineRequested": {"disputeCodes": [{"code": code}]}}
    cases = {
        "disjoint": ({"x": 1}, {"y": 2}, {"x": 1, "y": 2}),
        "later": ({"x": 1}, None, {"x": 1, "y": 2}),
        "collision": ({"z": "foo"}, {"z": "bar"}, {"z": "bar"}),
        "same": ({"z": "foo"}, {"z": "foo"}, {"z": "foo"}),
        "united": ({"tradelines": [line("A")]}, {"tradelines": [line("B")]}, {"tradelines": [line("A"), line("B")]}),
        "replaced": ({"attachments": [{"n": 1}]}, {"attachments": [{"n": 2}]}, {"attachments": [{"n": 2}]}),
        "same item": ({"tradelines": [line("A", "013")]}, {"tradelines": [line("A", "001")]}, {"tradelines": [line("A", "001")]}),
    }
    world.human([("submit", {"img": k} | a, "A", early) for k, (a, _, _) in cases.items()] + [("submit", {"img": k} | b, "B", late) for k, (_, b, _) in cases.items() if b])
    world.ai([("ai", {"img": k} | c, late) for k, (_, _, c) in cases.items()] + [("ai", {"img": "disjoint", "x": 9}, late - timedelta(minutes=9))])

    def by_image(rows):
        found = {}
        for r in rows:
            if r.field_name != "img":
                found.setdefault(r.image_id, {})[r.field_name, r.array_key] = r
        return found

    got = by_image(world.run(DAY))
    brief = lambda image: {f: (r.human_value, r.is_match, r.case_id) for (f, _), r in got[image].items()}
    assert brief("disjoint") == {"x": ("1", True, "A"), "y": ("2", True, "B")}
    assert brief("later")["x"] == ("1", True, "A") and not brief("later")["y"][1] and brief("later")["y"][0] is None
    assert brief("collision") == {"z": ("bar", True, "B")} and brief("same") == {"z": ("foo", True, "B")}
    assert {(k, r.case_id) for (f, k), r in got["united"].items() if f == "tradelines.accountNumber"} == {("a-1-d", "A"), ("b-1-d", "B")} and all(r.is_match for r in got["united"].values())
    assert brief("replaced") == {"attachments.n": ("2", True, "B")}
    codes = {f: (r.human_value, r.case_id) for (f, _), r in got["same item"].items() if f.endswith("code")}
    assert codes == {"tradelines.tradelineRequested.disputeCodes.code": ("001", "B")} and sum(f == "tradelines.accountNumber" for f, _ in got["same item"]) == 1
    # two payloads of an image that came at once are a second apart
    times = sorted(r.created_at for r in world.pool() if r.image_id == "disjoint")
    assert len(times) == 2 and times[1] - times[0] == timedelta(seconds=1)
    signatures = {r.image_id: r.last_compared_signature for r in world.pending()}
    # only the image with another case is compared again, as its next version; its first rows stay
    world.human([("submit", {"img": "later", "y": 2}, "B", DAY + timedelta(minutes=30))])
    got = by_image(world.run(DAY + timedelta(hours=1)))
    assert set(got) == {"later"} and brief("later") == {"x": ("1", True, "A"), "y": ("2", True, "B")} and {r.ai_iteration for r in got["later"].values()} == {2}
    assert {r.image_id: r.merged_case_ids for r in world.pending()}["later"] == "A;B"
    for hours in (2, 3):  # the lookback reads the same rows again
        assert world.run(DAY + timedelta(hours=hours)) == []
    after = {r.image_id: r.last_compared_signature for r in world.pending()}
    assert {k: v for k, v in after.items() if k != "later"} == {k: v for k, v in signatures.items() if k != "later"} and after["later"] != signatures["later"]
    versions = {r.image_id: r.comparison_version for r in world.pending()}
    assert versions == {**{k: 1 for k in cases}, "later": 2}
    assert {r.ai_iteration for r in results(world.spark, world.options).where("image_id = 'later'").collect()} == {1, 2}


def test_arrivals_trigger_runs(world):
    """What has arrived on either side since the last call is taken in one run; without arrivals there is none."""
    from braidwork.streaming.micro import run_available

    world.human([("submit", {"img": f"i{n}", "x": n}, "c", DAY - timedelta(minutes=30)) for n in range(30)])
    world.ai([("ai", {"img": f"i{n}", "x": n % 7}, DAY - timedelta(minutes=20)) for n in range(30)])
    steps = iter(range(9))
    call = lambda: run_available(world.spark, world.options, f"{world.root}/log", lambda: DAY + timedelta(hours=next(steps))).awaitTermination(240)
    assert call() and results(world.spark, world.options).count() == 60
    commits = len(state.Checkpoint(world.spark, world.options.checkpoint).commits())
    assert commits >= 1 and call() and len(state.Checkpoint(world.spark, world.options.checkpoint).commits()) == commits
    # each file of the results holds a range of images, in order
    rows = results(world.spark, world.options).select("image_id", "field_name", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")).orderBy("file", "at").collect()
    for file in {r.file for r in rows}:
        own = [(r.image_id, r.field_name) for r in rows if r.file == file]
        assert own == sorted(own)
