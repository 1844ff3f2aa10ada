"""Slots for functions that run outside of Spark: a process for each row, a worker for many, memoised Python functions.

Errors are data: every row comes back with a status, and a run takes up only what has no result yet.
"""

from __future__ import annotations

import json
import shlex
import subprocess
import tempfile
from collections.abc import Callable
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspan import schemas


def check_template(command: str) -> None:
    """A command needs a place for the output and one for an input."""
    if "{output}" not in command or not ("{input}" in command or "{input_wav}" in command):
        raise ValueError("the command needs {output}, and {input} or {input_wav}")


def pending(files: DataFrame, kv: DataFrame, output: str) -> DataFrame:
    """Files without the output yet."""
    return files.join(kv.where(F.col("type") == output).select("id"), "id", "left_anti")


def with_inputs(files: DataFrame, kv: DataFrame, inputs: list[str]) -> DataFrame:
    """Files with a map of their input blobs, and ``missing``: those that they lack."""
    blobs = kv.where(F.col("type").isin(inputs)).groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("type", "content"))).alias("inputs"))
    named = files.join(blobs, "id", "left") if inputs else files.withColumn("inputs", F.lit(None).cast("map<string,binary>"))
    have = F.coalesce(F.map_keys("inputs"), F.array().cast("array<string>"))
    return named.withColumn("missing", F.array_except(F.array(*[F.lit(i) for i in inputs]).cast("array<string>"), have))


def _answer(rows: list[dict]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["id", "status", "result", "error"])


def map_function(rows: DataFrame, make: Callable[[], Callable], column: str, key: str = "id") -> DataFrame:
    """(id, status, result, error): ``make()`` runs once for each task and gives the function from value to bytes."""

    def run(batches):
        call = make()
        for b in batches:
            out = []
            for k, value in zip(b[key], b[column], strict=True):
                try:
                    out.append({"id": k, "status": "success", "result": call(value), "error": None})
                except Exception as e:
                    out.append({"id": k, "status": "failed", "result": None, "error": f"{type(e).__name__}: {e}"})
            yield _answer(out)

    return rows.select(key, column).mapInPandas(run, schemas.RESULT)


def map_command(rows: DataFrame, command: str, output: str, base: str = "") -> DataFrame:
    """A process per file (id, path, inputs, missing): inputs are files of their names; the output file is the result."""
    check_template(command)

    def one(r) -> dict:
        if len(r.missing):
            return {"id": r.id, "status": "not_found", "result": None, "error": f"no {', '.join(r.missing)}"}
        with tempfile.TemporaryDirectory() as folder:  # a scratch folder of this process, gone when the row is done
            for name, data in (r.inputs or {}).items():
                Path(folder, name).write_bytes(data)
            places = {"input": folder, "input_wav": f"{base.rstrip('/')}/{r.path}" if base else r.path, "output": f"{folder}/{output}"}
            done = subprocess.run([x.format(**places) for x in shlex.split(command)], capture_output=True, text=True)
            if done.returncode:
                return {"id": r.id, "status": "failed", "result": None, "error": done.stderr[-2000:]}
            made = Path(folder, output)
            return {"id": r.id, "status": "success", "result": made.read_bytes(), "error": None} if made.exists() else {"id": r.id, "status": "failed", "result": None, "error": f"no {output}"}

    def run(batches):
        for b in batches:
            yield _answer([one(r) for r in b.itertuples(index=False)])

    return rows.select("id", "path", "inputs", "missing").mapInPandas(run, schemas.RESULT)


def map_worker(tasks: DataFrame, command: list[str]) -> DataFrame:
    """One worker process for each Spark task: a JSON line for each row (id, input_wav, input, output), a reply line
    'wrk-res: ok' or 'wrk-res: error ...' for each; the worker is ended with the task."""

    def run(batches):
        worker = subprocess.Popen(command, stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, bufsize=1)
        try:
            for b in batches:
                out = []
                for r in b.itertuples(index=False):
                    worker.stdin.write(json.dumps({"input_wav": r.input_wav, "input": r.input, "output": r.output}) + "\n")
                    reply = next((x for x in worker.stdout if x.startswith("wrk-res:")), "wrk-res: error worker ended")[8:].strip()
                    good = reply == "ok"
                    out.append({"id": r.id, "status": "success" if good else "failed", "result": None, "error": None if good else reply.removeprefix("error").strip()})
                yield _answer(out)
        finally:
            worker.kill()
            worker.wait()

    return tasks.select("id", "input_wav", "input", "output").mapInPandas(run, schemas.RESULT)


def map_files(files: DataFrame, kv: DataFrame, outputs: list[str], inputs: list[str], command: str, base: str = "") -> DataFrame:
    """Every file's result: skipped if its first output exists, else from its process."""
    if not outputs:
        raise ValueError("no outputs")
    waiting = pending(files, kv, outputs[0])
    done = files.join(waiting.select("id"), "id", "left_anti").select("id", F.lit("skipped").alias("status"), F.lit(None).cast("binary").alias("result"), F.lit(None).cast("string").alias("error"))
    return map_command(with_inputs(waiting, kv, inputs), command, outputs[0], base).unionByName(done)


def memoised(rows: DataFrame, memo: DataFrame, make: Callable[[], Callable], column: str) -> DataFrame:
    """(id, result, error, ok): results of the memo, and of the function where it has none; failures aren't remembered."""
    known = rows.select("id").join(memo.where("ok"), "id").select("id", "result", "error", "ok")
    fresh = map_function(rows.join(known.select("id"), "id", "left_anti"), make, column)
    return known.unionByName(fresh.select("id", "result", "error", (F.col("status") == "success").alias("ok")))
