"""Plans run by adapters in tasks: a backend is a function registered by name, each run has a time bound and a folder of its own,
and whatever goes wrong is a row.

A run's files lie in a folder of the task first and are copied to the plan's folder under a shared path; result.json is
written there last and under its final name at once, so that a plan is either done or not there. A plan that is done is read, not
run, when the job or one of its tasks runs again."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gablestone.operators import lifecycle
from gablestone.operators.shared import uri

RESULT = "building_id string, backend string, lod string, status string, succeeded boolean, files array<string>, folder string, reason string, seconds double, reused boolean"


class Backends:
    """Adapters by name: each takes a plan (a dict of its row) and a folder and leaves the model's files there."""

    def __init__(self):
        self._known: dict[str, Callable[[dict, str], object]] = {}

    def register(self, name: str, run: Callable[[dict, str], object]) -> None:
        if name == "auto":
            raise ValueError("auto is what the planner resolves, not a backend")
        if name in self._known:
            raise ValueError(f"{name} is registered already")
        self._known[name] = run

    def get(self, name: str) -> Callable[[dict, str], object]:
        if name == "auto":
            raise ValueError("auto is what the planner resolves, not a backend")
        if name not in self._known:
            raise KeyError(f"{name} is not registered")
        return self._known[name]

    def names(self) -> tuple[str, ...]:
        return tuple(sorted(self._known))


def _child(run, plan: dict, folder: str, pipe) -> None:
    try:
        run(plan, folder)
        pipe.send(None)
    except BaseException as e:  # a backend may do anything
        pipe.send(f"{type(e).__name__}: {e}")


def _bounded(run, plan: dict, folder: str, seconds: float) -> str | None:
    """Run in a process that can be ended; what went wrong, or None."""
    import multiprocessing

    context = multiprocessing.get_context("fork")
    ours, theirs = context.Pipe(False)
    process = context.Process(target=_child, args=(run, plan, folder, theirs), daemon=True)
    process.start()
    theirs.close()
    try:
        if not ours.poll(seconds):
            return f"no result within {seconds:g} s"
        return ours.recv()
    except EOFError:
        process.join()
        return f"the backend ended with code {process.exitcode}"
    finally:
        if process.is_alive():
            process.kill()
        process.join()


def _execute(plan: dict, run, base: str, seconds: float) -> dict:
    """The result of one plan: found, or worked out and committed."""
    import os
    import re
    import tempfile
    import time
    import uuid

    from pyarrow import fs

    backend, lod = plan["selected_backend"], plan["target_lod"]
    folder = f"{base.rstrip('/')}/{re.sub(r'[^A-Za-z0-9_-]', '_', str(plan['building_id']))}/{backend}-{lod}"
    where, path = fs.FileSystem.from_uri(folder)
    done = f"{path}/result.json"
    if where.get_file_info(done).type == fs.FileType.File:
        with where.open_input_file(done) as f:
            return json.loads(f.read()) | {"reused": True}
    began = time.time()
    with tempfile.TemporaryDirectory() as own:
        wrong = f"{backend} is not registered" if run is None else _bounded(run, plan, own, seconds)
        files = sorted(os.path.relpath(os.path.join(d, n), own) for d, _, names in os.walk(own) for n in names)
        if wrong is None and not files:
            wrong = "the backend left no file"
        where.create_dir(path, recursive=True)
        if wrong is None:
            local = fs.LocalFileSystem()
            for name in files:
                where.create_dir(os.path.dirname(f"{path}/{name}"), recursive=True)
                fs.copy_files(os.path.join(own, name), f"{path}/{name}", source_filesystem=local, destination_filesystem=where)
    result = {
        "building_id": str(plan["building_id"]), "backend": backend, "lod": lod, "status": "FAILED" if wrong else "SUCCEEDED", "succeeded": wrong is None, "files": [] if wrong else files, "folder": folder, "reason": wrong, "seconds": time.time() - began,
    }
    if wrong is None:  # a failure may be tried again
        mark = f"{done}.{uuid.uuid4().hex}"
        with where.open_output_stream(mark) as f:
            f.write(json.dumps(result).encode())
        where.move(mark, done)
    return result | {"reused": False}


def execute(plans: DataFrame, backends: Backends, output: str, seconds: float = 300.0, tasks: int | None = None) -> DataFrame:
    """A result for each executable plan (building_id, decision, selected_backend, target_lod and whatever else its backend reads); other
    plans have none. Results are written under output, where they are read from: running them is not repeated by a later action."""
    ready = plans.where("decision = 'execute'")
    names = list(ready.columns)
    base = uri(output)
    known = {n: backends.get(n) for n in backends.names()}

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = [_execute(dict(zip(names, r, strict=True)), known.get(r[names.index("selected_backend")]), f"{base}/plans", seconds) for r in pdf.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    # A plan may take minutes: they are dealt out a few to a task, not by the size of their rows.
    dealt = ready.repartition(tasks or max(1, min(ready.count(), 10 * ready.sparkSession.sparkContext.defaultParallelism)), "building_id")
    import uuid

    path = f"{base}/results/{uuid.uuid4().hex}"
    dealt.mapInPandas(run, RESULT).write.parquet(path)
    return plans.sparkSession.read.schema(RESULT).parquet(path)


def reconstruct(plans: DataFrame, backends: Backends, assess: Callable[[DataFrame], DataFrame], output: str, seconds: float = 300.0) -> tuple[DataFrame, DataFrame]:
    """(outcomes, results): each plan is run at its target level; those that succeed but that assess (results to results with a column
    accepted) does not accept are run once more at their fallback level, whose result stands."""
    plans = plans.withColumn("building_id", F.col("building_id").cast("string"))
    first = assess(execute(plans, backends, output, seconds))
    refused = first.where("succeeded and not accepted").select("building_id")
    again = plans.where("fallback_lod is not null").join(refused, "building_id", "left_semi").withColumn("target_lod", F.col("fallback_lod"))
    second = assess(execute(again, backends, output, seconds))
    results = first.unionByName(second)
    return lifecycle.outcomes(plans, results), results
