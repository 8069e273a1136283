"""Runs modules over lazily built tables. A module's tables are written below the run's folder as they are produced,
so a run with the same run_id resumes from them, and nothing is recomputed by those that read them."""

from __future__ import annotations

import hashlib
import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from cytolake.plans.config import Run
from cytolake.plans.dag import MANDATORY, tiers
from cytolake.sources.files import delete, exists, read_text, write_text


class Context:
    """Tables, metadata and status of a run; safe to share between threads."""

    def __init__(self, spark: SparkSession, cfg: Run) -> None:
        self.spark, self.cfg = spark, cfg
        self.run_dir = f"{cfg.output_dir.rstrip('/')}/{cfg.project}_{cfg.run_id}"
        self.tables: dict[str, DataFrame] = {}
        self.owner: dict[str, str] = {}
        self.metadata: dict = {}
        self.status: list[dict] = []
        self.runtime: dict[str, float] = {}
        self._lock = threading.Lock()

    def module_dir(self, module: str) -> str:
        return f"{self.run_dir}/{module}"

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise KeyError(f"no table {name!r} yet; a module that makes it has to run first")
        return self.tables[name]

    def __contains__(self, name: str) -> bool:
        return name in self.tables

    def load(self, module: str, name: str) -> None:
        df = self.spark.read.parquet(f"{self.module_dir(module)}/{name}")
        with self._lock:
            self.tables[name], self.owner[name] = df, module

    def put(self, module: str, name: str, df: DataFrame) -> DataFrame:
        """Writes a table; a later module may replace a table under its own folder."""
        df.write.mode("overwrite").parquet(f"{self.module_dir(module)}/{name}")
        self.load(module, name)
        return self.tables[name]

    def note(self, **values) -> None:
        with self._lock:
            self.metadata |= values

    def say(self, module: str, ok: bool, message: str) -> None:
        with self._lock:
            self.status.append({"module": module, "ok": ok, "message": message})


class Engine:
    def __init__(self, spark: SparkSession, cfg: Run, registry: dict | None = None, depends: dict | None = None) -> None:
        from cytolake.plans.dag import DEPENDS
        from cytolake.plans.modules import REGISTRY

        self.cfg, self.registry, self.depends = cfg, registry or REGISTRY, depends or DEPENDS
        if bad := cfg.problems():
            raise ValueError("; ".join(bad))
        self.ctx = Context(spark, cfg)
        self.mandatory = [m for m in MANDATORY if m in self.depends]

    def fingerprint(self) -> str:
        return hashlib.blake2b(json.dumps(self.cfg.as_dict() | {"resume_from": None, "modules": []}, sort_keys=True, default=str).encode(), digest_size=20).hexdigest()

    def _done(self, module: str) -> str:
        return f"{self.ctx.module_dir(module)}/_done.json"

    def _resume(self, plan: list[list[str]]) -> set[str]:
        """Loads what modules before the one to resume from have left."""
        start, done = self.cfg.resume_from, set()
        if start is None:
            return done
        flat = [m for tier in plan for m in tier]
        if start not in flat:
            raise ValueError(f"{start} is not part of this run")
        for m in flat[: flat.index(start)]:
            if not exists(self.ctx.spark, self._done(m)):
                raise ValueError(f"cannot resume from {start}: {m} has left nothing in {self.ctx.run_dir}")
            told = json.loads(read_text(self.ctx.spark, self._done(m)))
            for name in told["tables"]:
                self.ctx.load(m, name)
            self.ctx.metadata |= told["metadata"]
            self.ctx.say(m, True, "resumed")
            done.add(m)
        return done

    def _one(self, module: str) -> None:
        ctx, began = self.ctx, time.time()
        before = dict(ctx.metadata)
        try:
            delete(ctx.spark, self._done(module))
            self.registry[module](ctx)
        except Exception as e:
            ctx.say(module, False, f"{type(e).__name__}: {e}")
            if module in self.mandatory:
                raise
        else:
            ctx.say(module, True, "completed")
            told = {"tables": [n for n, m in ctx.owner.items() if m == module], "metadata": {k: v for k, v in ctx.metadata.items() if before.get(k) != v}, "fingerprint": self.fingerprint()}
            write_text(ctx.spark, self._done(module), json.dumps(told, default=str))
        finally:
            ctx.runtime[module] = round(time.time() - began, 3)

    def run(self) -> Context:
        ctx, began = self.ctx, time.time()
        plan = tiers([*self.mandatory, *self.cfg.modules], self.depends)
        done = self._resume(plan)
        try:
            for tier in plan:
                todo = [m for m in tier if m not in done]
                ready = [m for m in todo if all(self._ok(d) for d in self.depends[m])]
                for m in set(todo) - set(ready):
                    ctx.say(m, False, "skipped: a module that it needs has failed")
                if self.cfg.workers == 1 or len(ready) < 2:
                    for m in ready:
                        self._one(m)
                else:
                    with ThreadPoolExecutor(min(self.cfg.workers, len(ready))) as pool:
                        for f in [pool.submit(self._one, m) for m in ready]:
                            f.result()
        finally:
            ctx.note(module_runtime_sec=dict(ctx.runtime), pipeline_wall_seconds=round(time.time() - began, 3))
            self.manifest()
        return ctx

    def _ok(self, module: str) -> bool:
        return any(s["module"] == module and s["ok"] for s in self.ctx.status)

    def manifest(self) -> str:
        ctx = self.ctx
        body = {"project": self.cfg.project, "generated_at": datetime.now(UTC).isoformat().replace("+00:00", "Z"), "run_dir": ctx.run_dir, "optional_modules": self.cfg.modules, "module_status": ctx.status, "metadata": ctx.metadata}
        write_text(ctx.spark, f"{ctx.run_dir}/run_manifest.json", json.dumps(body, indent=2, default=str))
        rows = ["module,ok,message", *(f'{s["module"]},{s["ok"]},"{s["message"]}"' for s in ctx.status)]
        write_text(ctx.spark, f"{ctx.run_dir}/module_status.csv", "\n".join(rows) + "\n")
        return f"{ctx.run_dir}/run_manifest.json"
