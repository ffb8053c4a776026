"""Graphs of tasks: run, validate, info."""

from .. import dag


def arguments(parser) -> None:
    parser.add_argument("action", choices=["run", "validate", "info"])
    parser.add_argument("file")
    parser.add_argument("--mode", default="sequential", choices=["sequential", "parallel"])
    parser.add_argument("--task", help="only this one and what it needs")
    parser.add_argument("--dry-run", action="store_true", help="check, and run nothing")


def run(given, context) -> int:
    made = dag.load(given.file)
    found = made.errors()
    if found or given.action != "run" or given.dry_run:
        order = {"order": [{"id": i, "needs": made.tasks[i].depends_on} for i in made.order()]} if not found else {}
        told = {"name": made.name, "description": made.description, **made.stats(), "tasks_by_id": {i: {"type": t.type, "config": t.config} for i, t in made.tasks.items()}} if given.action == "info" else {}
        context.tell({"errors": found} | order | told)
        return int(bool(found))
    runner = dag.Runner(context.handlers.by_type(), context.settings.workers, context.spark)
    said = runner.run_one(made, given.task) if given.task else runner.run(made, given.mode)
    context.tell(said)
    return int("failed" in said["tasks"])
