"""Command line: ``python -m lodestrand COMMAND``.

Exit status: 0, 1 where a rule refuses (an audit with errors, an empty release), 2 where capacity is short or files failed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import curate, dedup, passages, planner, questions, records, registry, report, retrieval, sampling
from .session import local_session, ship
from .sources import extract, registry_file, tables

REFUSED, SHORT = 1, 2


def _audit(spark: SparkSession, a: argparse.Namespace) -> int:
    found = registry.audit(registry_file.load_registry(spark, a.registry), a.contact)
    found.orderBy("severity", "source_id", "code").show(1000, truncate=False)
    return REFUSED if found.filter("severity = 'error'").limit(1).count() else 0


def _extract(spark: SparkSession, a: argparse.Namespace) -> int:
    files = tables.read_files(spark, a.input)
    out = dedup.cut(extract.extract(files, a.article))
    tables.write_records(out.filter("error is null").drop("error"), a.output)
    failed = out.filter("error is not null").select("path", "error")
    failed.show(100, truncate=False)
    return SHORT if failed.limit(1).count() else 0


def _curate(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = spark.read.json(a.input) if a.kind == "json" else spark.read.parquet(a.input)
    tables.write_records(curate.curate(docs, a.key, a.text, exact=True), a.output, "parquet")
    return 0


def _passages(spark: SparkSession, a: argparse.Namespace) -> int:
    docs = spark.read.schema(records.schema("document")).parquet(a.input)
    rows = dedup.cut(passages.passages(passages.releasable(docs).filter("accepted")))
    tables.write_records(rows, a.output, "parquet")
    passages.passage_stats(rows).show()
    return 0 if rows.limit(1).count() else REFUSED


def _plan(spark: SparkSession, a: argparse.Namespace) -> int:
    found = dedup.stored(passages.evidence_candidates(spark.read.parquet(a.input)))
    try:
        tasks, _ = planner.plan_tasks(found, a.target, a.seed)
    except planner.CapacityError as e:
        print(json.dumps(e.issues, ensure_ascii=False), file=sys.stderr)
        return SHORT
    print(planner.prepare_run(tasks, a.output))
    return 0


def _questions(spark: SparkSession, a: argparse.Namespace) -> int:
    rows, docs, tasks = spark.read.parquet(a.passages), spark.read.parquet(a.documents), spark.read.parquet(f"{a.folder}/tasks")
    found = dedup.stored(passages.evidence_candidates(rows))
    made = dedup.cut(questions.generate(tasks, found))
    judged = questions.validate(made, rows, docs, found)
    strata = ["question_language", "primary_type", "cross_lingual"]
    quotas = sampling.quota_table(spark, tasks.count()).filter("answerability = 'answerable'").select(*strata, "count")
    parts = questions.settle(judged.drop("task_index"), planner.task_order(tasks, made), quotas, strata)
    for name, part in parts.items():
        tables.write_records(part, f"{a.folder}/{name}", "parquet")
    return SHORT if parts["deficits"].limit(1).count() else 0


def _review(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = spark.read.parquet(a.input)
    sample = sampling.review_sample(rows, a.strata, a.key, a.rate) if a.double else sampling.sample_per_stratum(rows, a.strata, a.key, a.rate)
    tables.write_records(sample.select(a.key, *a.strata, *(["reviewer_slot"] if a.double else [])), a.output, "csv")
    return 0


def _report(spark: SparkSession, a: argparse.Namespace) -> int:
    gates = dedup.cut(report.gate_rows(spark.read.json(a.facts)))
    gates.show(truncate=False)
    verdict = sampling.verdict(gates).first().verdict
    print(verdict)
    return REFUSED if verdict == "fail" else 0


def _evaluate(spark: SparkSession, a: argparse.Namespace) -> int:
    found = retrieval.bm25(spark.read.parquet(a.passages), spark.read.parquet(a.queries), a.pid, a.qid)
    per = retrieval.retrieval_metrics(found, spark.read.parquet(a.relevant), a.qid, a.pid)
    retrieval.breakdown(per, [], list(retrieval.METRICS)).show(truncate=False)
    return 0


def _schemas(spark: SparkSession, a: argparse.Namespace) -> int:
    print(json.dumps({name: records.export(name) for name in records.SCHEMAS}, indent=1))
    return 0


def _query(spark: SparkSession, a: argparse.Namespace) -> int:
    from .plans import catalog, more  # noqa: F401  more registers its queries in the catalog

    rows = catalog.QUERIES[a.name](spark, a.tables)
    if a.output:
        rows.write.mode("overwrite").parquet(a.output)
    else:
        rows.orderBy(*(F.col(f"`{c}`") for c in rows.columns[:1])).show(20, truncate=False)
    return 0


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="lodestrand", description=__doc__.splitlines()[0])
    sub = p.add_subparsers(required=True, metavar="COMMAND")

    def command(name: str, run, *arguments: str, **options) -> None:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for x in arguments:
            c.add_argument(x)
        for k, v in options.items():
            c.add_argument(f"--{k}", **(v if isinstance(v, dict) else {"default": v, "type": type(v)}))

    flag, names = {"action": "store_true"}, {"nargs": "*", "default": []}
    command("audit", _audit, "registry", contact="")
    command("extract", _extract, "input", "output", article=flag)
    command("curate", _curate, "input", "output", kind="parquet", key="document_id", text="text")
    command("passages", _passages, "input", "output")
    command("plan", _plan, "input", "output", target=1500, seed=7)
    command("questions", _questions, "folder", "passages", "documents")
    command("review", _review, "input", "output", key="qa_id", rate=0.15, strata=names, double=flag)
    command("report", _report, "facts")
    command("evaluate", _evaluate, "passages", "queries", "relevant", pid="passage_id", qid="qa_id")
    command("schemas", _schemas)
    command("query", _query, "name", "tables", output="")
    return p


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(arguments)
    session = spark or local_session()
    session.sparkContext.setLogLevel("ERROR")
    ship(session)
    return a.run(session, a)


if __name__ == "__main__":
    sys.exit(main())
