"""From points to plans, and plans run by adapters that succeed, fail, hang, die and leave nothing."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablestone.operators import chain, execution

EDGES = "building_id long, polygon_id long, ring_id long, edge_id long, x1 double, y1 double, x2 double, y2 double"


def square(building, x, y, w):
    p = [(x, y), (x + w, y), (x + w, y + w), (x, y + w)]
    return [(building, 0, 0, k, *map(float, p[k]), *map(float, p[(k + 1) % 4])) for k in range(4)]


@pytest.fixture(scope="module")
def evidence(spark):
    """A dense gable roof, a sparse one, and a building without points."""
    rng, rows = np.random.default_rng(1), []
    for b, x0, n in ((1, 0.0, 2000), (2, 100.0, 30)):
        for x, y in rng.uniform(0.01, 15.99, (n, 2)):
            rows.append((x0 + x, y, 110 + 0.6 * min(x, 16 - x), 6))
        rows += [(x0 - 5 + float(k) / 10, -3.0, 100.0, 2) for k in range(60)]
    points = spark.createDataFrame([(i, *map(float, r[:3]), r[3]) for i, r in enumerate(rows)], "k long, x double, y double, z double, classification long")
    edges = spark.createDataFrame(square(1, 0, 0, 16) + square(2, 100, 0, 16) + square(3, 300, 0, 16), EDGES)
    ground = [(b, r, c, 100.0, x, 0.0) for b, x in ((1, 0.0), (2, 100.0), (3, 300.0)) for r in range(8) for c in range(8)]
    terrain = spark.createDataFrame(ground, "building_id long, trow long, tcol long, elevation double, tx double, ty double")
    return chain.measured(points, edges, terrain, ["k"]).cache()


def requests(spark, lod, policy="strict", backend="auto", priority="normal", buildings=(1, 2, 3)):
    return spark.createDataFrame([(b, lod, policy, backend, priority) for b in buildings], "building_id long, lod_request string, policy string, backend_request string, priority string")


def test_evidence_is_measured_from_points(evidence):
    assert evidence.columns == chain.EVIDENCE
    one, two, three = evidence.orderBy("building_id").collect()
    assert one.planes == 2 and one.normals == 2 and one.explained > 0.95 and one.planar > 0.9 and one.density == pytest.approx(2000 / 256) and one.coverage > 0.95 and one.valid_ratio == 1 and one.alignment == 1
    assert (one.footprint_ok, one.ground_ok, one.height_ok, one.available) == (True, True, True, True)
    assert two.density < 1 and (three.roof_points, three.planes, three.ground_ok, three.height_ok, three.valid_ratio) == (0, 0, False, False, 0)


def test_the_plan_follows_from_the_points(spark, evidence):
    got = {r.building_id: r for r in chain.decided(evidence, requests(spark, "auto")).collect()}
    assert (got[1].highest_lod, got[1].target_lod, got[1].selected_backend, got[1].decision) == ("2.2", "2.2", "roofer", "execute")
    assert got[2].highest_lod in ("1.2", "1.3") and got[2].roof_form == "INSUFFICIENT_EVIDENCE" and not got[2].lod22 and got[2].lod12
    assert (got[3].highest_lod, got[3].decision) == (None, "no_lod")
    strict = {r.building_id: r.decision for r in chain.decided(evidence, requests(spark, "2.2")).collect()}
    assert strict == {1: "execute", 2: "no_lod", 3: "no_lod"}
    lower = {r.building_id: (r.target_lod, r.fallback_lod) for r in chain.decided(evidence, requests(spark, "2.2", "fallback")).collect()}
    assert lower[2][0] in ("1.2", "1.3") and lower[3] == (None, None) and lower[1][0] == "2.2"
    none = chain.decided(evidence, requests(spark, "auto", backend="city3d"), installed=("roofer",)).where("building_id = 1").first()
    assert (none.decision, none.selected_backend) == ("no_backend", None)
    wrong = chain.decided(evidence, requests(spark, "auto", "force_experimental")).first()
    assert wrong.decision == "invalid_request" and wrong.target_lod is None and wrong.request_error
    assert chain.decided(evidence, requests(spark, "auto", buildings=(77,))).first().decision == "no_lod"


PLAN = "building_id long, decision string, selected_backend string, target_lod string, fallback_lod string"


def stub(plan, folder):
    """What a backend may do, by the building's number."""
    b = plan["building_id"]
    with open(os.environ["STUB_LOG"], "a") as f:
        f.write(f"{b} {plan['target_lod']}\n")
    if int(b) == 2:
        raise RuntimeError("no such roof")
    if int(b) == 3:
        time.sleep(60)
    if int(b) == 4:
        os._exit(7)
    if int(b) != 5:
        os.makedirs(f"{folder}/sub")
        with open(f"{folder}/sub/model.obj", "w") as f:
            f.write(f"{b} {plan['target_lod']}")


@pytest.fixture
def backends(tmp_path, monkeypatch):
    log, own = str(tmp_path / "log"), execution.Backends()
    open(log, "w").close()

    def run(plan, folder):
        os.environ["STUB_LOG"] = log
        stub(plan, folder)

    own.register("roofer", run)
    return own


def calls(tmp_path):
    return sorted((tmp_path / "log").read_text().split("\n")[:-1])


def test_every_end_of_a_run_is_a_row(spark, backends, tmp_path):
    plans = spark.createDataFrame([(b, "execute", "roofer", "2.2", None) for b in (1, 2, 3, 4, 5)] + [(6, "execute", "city3d", "2.2", None), (7, "no_lod", None, None, None)], PLAN)
    began = time.time()
    got = {r.building_id: r for r in execution.execute(plans, backends, str(tmp_path / "out"), seconds=3, tasks=4).collect()}
    assert time.time() - began < 50 and got.keys() == {"1", "2", "3", "4", "5", "6"} and calls(tmp_path) == [f"{b} 2.2" for b in (1, 2, 3, 4, 5)]
    assert (got["1"].status, got["1"].files, got["1"].reused) == ("SUCCEEDED", ["sub/model.obj"], False)
    with open(got["1"].folder.removeprefix("file://") + "/sub/model.obj") as f:
        assert f.read() == "1 2.2"
    reasons = {b: r.reason for b, r in got.items()}
    assert reasons["2"] == "RuntimeError: no such roof" and "within 3 s" in reasons["3"] and "code 7" in reasons["4"] and reasons["5"] == "the backend left no file" and reasons["6"] == "city3d is not registered"
    assert all(r.status == "FAILED" for b, r in got.items() if b != "1")


def test_finished_plans_are_not_run_again(spark, backends, tmp_path):
    plans = spark.createDataFrame([(b, "execute", "roofer", "2.2", None) for b in (1, 2, 8)], PLAN)
    for again in (False, True):
        got = {r.building_id: (r.status, r.reused) for r in execution.execute(plans, backends, str(tmp_path / "out"), 20).collect()}
        assert got == {"1": ("SUCCEEDED", again), "8": ("SUCCEEDED", again), "2": ("FAILED", False)}
    assert calls(tmp_path) == ["1 2.2", "2 2.2", "2 2.2", "8 2.2"]  # the failure only is tried again


def test_one_fallback_for_what_is_not_accepted(spark, backends, tmp_path):
    plans = spark.createDataFrame([(1, "execute", "roofer", "2.2", "1.2"), (2, "execute", "roofer", "2.2", "1.2"), (8, "execute", "roofer", "2.2", "1.3"), (9, "execute", "roofer", "2.2", None), (10, "no_lod", None, None, None)], PLAN)
    assess = lambda df: df.withColumn("accepted", F.col("succeeded") & ((F.col("building_id") == "1") | (F.col("lod") != "2.2")))
    outcomes, results = execution.reconstruct(plans, backends, assess, str(tmp_path / "out"), 20)
    got = {r.building_id: (r.status, r.delivered_lod, r.warning is not None) for r in outcomes.collect()}
    assert got == {"1": ("SUCCEEDED", "2.2", False), "2": ("FAILED", None, False), "8": ("SUCCEEDED", "1.3", True), "9": ("ABSTAINED", None, False), "10": ("ABSTAINED", None, False)}
    assert calls(tmp_path) == ["1 2.2", "2 2.2", "8 1.3", "8 2.2", "9 2.2"] and results.count() == 5


def test_names_of_backends():
    own = execution.Backends()
    own.register("b", print)
    own.register("a", print)
    assert own.names() == ("a", "b") and own.get("a") is print
    for wrong in (lambda: own.register("a", print), lambda: own.register("auto", print), lambda: own.get("auto")):
        with pytest.raises(ValueError):
            wrong()
    with pytest.raises(KeyError):
        own.get("c")
