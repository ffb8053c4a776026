"""A graph of tasks on the driver: checks, orders, runs. Tasks build and start Spark jobs; data stays in tables."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import asdict, dataclass, field
from typing import Any

FAIL, SKIP = "fail", "skip"


@dataclass
class Task:
    id: str
    type: str
    depends_on: list[str] = field(default_factory=list)
    config: dict = field(default_factory=dict)
    retries: int = 0
    timeout: float | None = None
    on_failure: str = FAIL
    status: str = "pending"
    result: Any = None
    error: str = ""
    seconds: float = 0.0


class Graph:
    """Tasks in insertion order."""

    def __init__(self, name: str = "graph", description: str = ""):
        self.name, self.description, self.tasks = name, description, {}

    def add(self, task: Task) -> Task:
        if task.id in self.tasks:
            raise ValueError(f"task exists: {task.id}")
        self.tasks[task.id] = task
        return task

    def depend(self, task: str, on: str) -> None:
        for t in (task, on):
            if t not in self.tasks:
                raise KeyError(f"unknown task: {t}")
        if on not in self.tasks[task].depends_on:
            self.tasks[task].depends_on.append(on)

    def layers(self) -> list[list[str]]:
        """Tasks by depth, each after all it needs; those in a cycle, or above one, are in none."""
        left, done, out = dict(self.tasks), set(), []
        while ready := [i for i, t in left.items() if set(t.depends_on) & set(self.tasks) <= done]:
            out.append(ready)
            done |= set(ready)
            for i in ready:
                del left[i]
        return out

    def errors(self) -> list[str]:
        lacking = [f"{t.id} depends on unknown {d}" for t in self.tasks.values() for d in t.depends_on if d not in self.tasks]
        placed = {i for layer in self.layers() for i in layer}
        stuck = [i for i in self.tasks if i not in placed]
        return lacking + ([f"cycle among: {', '.join(stuck)}"] if stuck else [])

    def order(self) -> list[str]:
        """Dependencies first, insertion order among equals."""
        if found := self.errors():
            raise ValueError("; ".join(found))
        need = {i: set(t.depends_on) for i, t in self.tasks.items()}
        out: list[str] = []
        queue = [i for i, n in need.items() if not n]
        while queue:
            out.append(i := queue.pop(0))
            for j, n in need.items():
                if i in n:
                    n.discard(i)
                    if not n:
                        queue.append(j)
        return out

    def ready(self) -> list[str]:
        done = {i for i, t in self.tasks.items() if t.status in ("done", "skipped")}
        return [i for i, t in self.tasks.items() if t.status == "pending" and set(t.depends_on) <= done]

    def dependents(self, task: str) -> list[str]:
        return [i for i, t in self.tasks.items() if task in t.depends_on]

    def ancestors(self, task: str) -> set[str]:
        seen: set[str] = set()
        waiting = list(self.tasks[task].depends_on)
        while waiting:
            if (i := waiting.pop()) not in seen:
                seen.add(i)
                waiting += self.tasks[i].depends_on
        return seen

    def stats(self) -> dict:
        kinds: dict[str, int] = {}
        for t in self.tasks.values():
            kinds[t.type] = kinds.get(t.type, 0) + 1
        return {"tasks": len(self.tasks), "edges": sum(len(t.depends_on) for t in self.tasks.values()), "depth": len(self.layers()), "types": kinds}

    def to_dict(self) -> dict:
        kept = ("id", "type", "depends_on", "config", "retries", "timeout", "on_failure")
        return {"name": self.name, "tasks": [{k: v for k, v in asdict(t).items() if k in kept} for t in self.tasks.values()]}

    @staticmethod
    def from_dict(spec: dict) -> Graph:
        """Tasks as a list with their ids, or as a mapping by id; unknown keys of a task are dropped."""
        graph = Graph(spec.get("name") or spec.get("dag_id") or "graph", spec.get("description") or "")
        told = spec.get("tasks") or []
        for t in [{"id": i, **(t or {})} for i, t in told.items()] if isinstance(told, dict) else told:
            needs = t.get("depends_on") or t.get("dependencies") or []
            graph.add(Task(t["id"], t.get("type") or t.get("task_type") or "task", list(needs), dict(t.get("config") or {}), int(t.get("retries", 0)), t.get("timeout"), t.get("on_failure", FAIL)))
        return graph


def load(path: str) -> Graph:
    """YAML where its parser is installed; JSON, which is YAML too, always."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    try:
        return Graph.from_dict(json.loads(text))
    except ValueError:
        import yaml

        return Graph.from_dict(yaml.safe_load(text))


def save(graph: Graph, path: str) -> None:
    with open(path, "w", encoding="utf-8") as f:
        json.dump(graph.to_dict(), f, indent=2)


class OutOfTime(TimeoutError):
    """A task's time limit has ended its work."""


#: What a job group is to the thread that starts jobs.
GROUP = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


class Limit:
    """Ends the Spark jobs that the thread starts inside it once ``seconds`` are over, and says so in place of Spark's error."""

    def __init__(self, spark, name: str, seconds: float | None):
        self.spark, self.seconds, self.over, self.done = spark, seconds, False, False
        self.name, self.group, self.before = name, f"limit-{uuid.uuid4().hex}", {}

    def _start(self, seconds: float) -> None:
        self.timer = threading.Timer(seconds, self._end)
        self.timer.daemon = True
        self.timer.start()

    def _end(self) -> None:
        self.over = True
        self.spark.sparkContext.cancelJobGroup(self.group)
        if not self.done:  # jobs that it starts after these are ended as well
            self._start(0.5)

    def __enter__(self) -> Limit:
        if self.spark is not None and self.seconds:
            sc = self.spark.sparkContext
            self.before = {p: sc.getLocalProperty(p) for p in GROUP}
            sc.setJobGroup(self.group, f"task {self.name}", True)
            self._start(self.seconds)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if self.spark is not None and self.seconds:
            self.done = True
            self.timer.cancel()
            for p, value in self.before.items():
                self.spark.sparkContext.setLocalProperty(p, value)
            if self.over and error is not None:
                raise OutOfTime(f"over its limit of {self.seconds} s") from error
        return False


class Runner:
    """Runs a graph with a handler a task type. A failed task stops the run (fail), counts as done (skip), or blocks its dependents in
    parallel and lets them run in sequence (anything else). Retries are immediate. With a session, a task's time limit ends its Spark jobs, try by try; such a try isn't repeated."""

    def __init__(self, handlers: dict[str, Callable[[Task], Any]], workers: int = 4, spark=None):
        self.handlers, self.workers, self.spark = handlers, workers, spark

    def run_task(self, task: Task) -> bool:
        began = time.monotonic()
        for _ in range(task.retries + 1):
            task.status = "running"
            try:
                if task.type not in self.handlers:
                    raise LookupError(f"no handler for {task.type}")
                with Limit(self.spark, task.id, task.timeout):
                    task.result = self.handlers[task.type](task)
                task.status, task.error = "done", ""
                break
            except OutOfTime as e:
                task.status, task.error = "failed", f"{type(e).__name__}: {e}"
                break
            except Exception as e:  # told in the summary; the policy decides what follows
                task.status, task.error = "failed", f"{type(e).__name__}: {e}"
        task.seconds = time.monotonic() - began
        if task.status == "failed" and task.on_failure == SKIP:
            task.status = "skipped"
        return task.status in ("done", "skipped")

    def run(self, graph: Graph, mode: str = "sequential") -> dict:
        if found := graph.errors():
            raise ValueError("; ".join(found))
        if mode not in ("sequential", "parallel"):
            raise ValueError(f"unknown mode: {mode}")
        if mode == "sequential":
            for i in graph.order():
                if not self.run_task(graph.tasks[i]) and graph.tasks[i].on_failure == FAIL:
                    break
            return self.summary(graph)
        with ThreadPoolExecutor(self.workers) as pool:
            while ready := graph.ready():
                wait([pool.submit(self.run_task, graph.tasks[i]) for i in ready])
                if any(graph.tasks[i].status == "failed" and graph.tasks[i].on_failure == FAIL for i in ready):
                    break
        return self.summary(graph)

    def run_one(self, graph: Graph, task: str) -> dict:
        """A task after all it needs."""
        need = graph.ancestors(task) | {task}
        for i in graph.order():
            if i in need and not self.run_task(graph.tasks[i]):
                break
        return self.summary(graph)

    @staticmethod
    def summary(graph: Graph) -> dict:
        by: dict[str, list[str]] = {}
        for i, t in graph.tasks.items():
            by.setdefault(t.status, []).append(i)
        n = len(graph.tasks)
        return {"tasks": by, "seconds": sum(t.seconds for t in graph.tasks.values()), "success_pct": 100.0 * len(by.get("done", [])) / n if n else 0.0, "errors": {i: t.error for i, t in graph.tasks.items() if t.error}}
