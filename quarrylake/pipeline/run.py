"""Layers run in order, each step as a batch of its own: raw, resolved, star, quality. Also the command line."""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import calendar
from ..functions.text import same_text
from ..operators.history import History, type2_merge
from ..operators.intervals import segments
from ..operators.quality import Check, evaluate, gate, stamped
from ..operators.windows import first_by
from ..session import written
from ..sources.ingest import ingest
from ..sources.registry import Registry
from ..sources.store import TableStore, self_check
from . import claims, config, gold, links, measures, people, procedures, rules, stays

LAYERS = ("raw", "resolved", "star", "quality")
SCORECARD = "quality/scorecard"


class Pipeline:
    """A network's data in a store, by a configuration (see config.load)."""

    def __init__(self, spark: SparkSession, root: str, settings: Mapping[str, Any]):
        self.spark, self.settings = spark, settings
        self.store = TableStore(spark, root)
        self.registry = Registry(self.store)
        self.contracts = config.contracts(settings)

    def raw(self, name: str) -> DataFrame | None:
        """Archived rows of a source with the contract's types, or None where nothing was delivered."""
        if not self.store.exists(f"raw/{name}"):
            return None
        return self.contracts[name].typed(self.store.read(f"raw/{name}"))

    def need(self, name: str) -> DataFrame:
        df = self.raw(name)
        if df is None:
            raise FileNotFoundError(f"no raw rows of {name}")
        return df

    # --- resolved ----------------------------------------------------------------------------------------------------

    def people(self, _: str) -> int:
        s = self.settings["people"]
        regs = people.registrations(self.need("registrations"), s.get("formats"))
        people.resolve(self.store, regs, accept=s["accept"], review=s["review"])
        return self.store.row_count(people.MASTER)

    def doctors(self, _: str) -> int:
        new = self.need("doctors").withColumn("__from", F.coalesce("effective_date", "ingest_date")).withColumn("__to", F.lit(None).cast("date"))
        attributes = {c: same_text(F.col(c)) for c in ("department", "hospital_id", "specialty", "designation")}
        before = History(self.store.read("doctors/rows"), self.store.read("doctors/versions")) if self.store.exists("doctors/versions") else None
        out = type2_merge(before, new, "doctor_id", "__from", "__to", attributes, ["ingest_date", "ingestion_ts"]).stored("doctors")
        self.store.overwrite("doctors/rows", out.rows)
        self.store.overwrite("doctors/versions", out.versions)
        return self.store.row_count("doctors/versions")

    def claims(self, _: str) -> int:
        raw = self.need("claims")
        rows = claims.normalized(raw if "export_date" in raw.columns else raw.withColumnRenamed("ingest_date", "export_date"), "claim_status")
        claims.take(self.store, rows)
        return self.store.row_count(claims.LIFECYCLE)

    def procedures(self, _: str) -> int:
        known = self.spark.read.option("header", True).option("comment", "#").csv(self.settings["seeds"]["catalogue"])
        self.store.overwrite("procedures/coded", procedures.coded(self.need("procedures"), known))
        return self.store.row_count("procedures/coded")

    def stays(self, day: str) -> int:
        s, place = self.settings["stays"], ["hospital_id", "ward_id"]
        events = first_by(self.need("movements"), ["event_id"], [F.desc("ingestion_ts"), F.desc("source_file")])  # files repeat events
        parts = written(segments(events, "visit_id", "event_ts", "event_id", "event_type", s["entries"], day, s["cap_days"]), "segments")
        self.store.overwrite("stays/segments", parts)
        self.store.overwrite("stays/days", stays.ward_days(parts, stays.capacities(self.raw("wards"), parts, place, "bed_number"), place, "patient_id"))
        return self.store.row_count("stays/days")

    def links(self, _: str) -> int:
        latest = first_by(claims.normalized(self.need("claims"), "claim_status"), ["claim_id"], [F.desc("ingest_date"), F.desc("ingestion_ts")])
        s = self.settings["links"]
        found = links.link(latest, first_by(self.need("bills"), ["bill_id"], [F.desc("ingestion_ts")]), s["days"], s["share"])
        self.store.overwrite("links/accepted", found.accepted)
        self.store.overwrite("links/review", found.review)
        return self.store.row_count("links/accepted")

    # --- star --------------------------------------------------------------------------------------------------------

    def star(self, day: str) -> int:
        store, read = self.store, self.store.read
        c = self.settings["calendar"]
        holidays = rules.load_seeds(self.spark, {"holidays": self.settings["seeds"]["holidays"]})["holidays"] if "holidays" in self.settings["seeds"] else None
        walk = read(people.CROSSWALK)
        latest = lambda name, key: first_by(self.need(name), key, [F.desc("ingestion_ts")])
        wards = latest("wards", ["hospital_id", "ward_id"]) if self.raw("wards") is not None else None
        tables: dict[str, Callable[[], DataFrame]] = {
            "dim_date": lambda: calendar(self.spark, c["start"], c["end"], holidays=holidays),
            "dim_patient": lambda: gold.dim_patient(read(people.MASTER).drop("hospitals"), walk, day),
            "dim_doctor": lambda: gold.dim_doctor(read("doctors/versions"), day),
            "dim_hospital": lambda: gold.dim_hospital(latest("hospitals", ["hospital_id"]), wards),
            "dim_procedure": lambda: procedures.dim_procedure(read("procedures/coded")),
            "fact_patient_visit": lambda: gold.fact_patient_visit(latest("visits", ["visit_id"]), read("doctors/versions"), walk, self.settings["visits"]["return_days"]),
            "fact_claim_lifecycle": lambda: gold.fact_claim_lifecycle(read(claims.LIFECYCLE), walk),
            "fact_bed_occupancy": lambda: stays.fact_bed_occupancy(read("stays/days"), ["hospital_id", "ward_id"]),
        }
        n = 0
        for name, build in tables.items():
            store.overwrite(f"star/{name}", build())
            n += store.row_count(f"star/{name}")
        return n

    # --- quality -----------------------------------------------------------------------------------------------------

    def quality(self, _: str) -> int:
        checks = [Check(**{k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in self.settings["quality"]["checks"]]
        read = lambda name: self.store.read(name) if self.store.exists(name) else None
        rows = evaluate(self.spark, read, checks)
        told = measures.lifecycle_health(self.store.read(claims.LIFECYCLE)).unionByName(measures.code_fill(self.store.read("procedures/coded")))
        told = told.unionByName(measures.link_health(self.store.read("links/accepted"), self.store.read("links/review"), self.need("claims")))
        more = told.select("check_name", F.lit("").alias("table_name"), F.lit("recovery").alias("kind"), "value", F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("passed"), F.lit(False).alias("blocking"))
        out = written(stamped(rows.unionByName(more), uuid.uuid4().hex), "scorecard")
        self.store.append(SCORECARD, out)
        if self.settings["quality"].get("fail", True):
            gate(out)
        return out.count()

    # --- running -----------------------------------------------------------------------------------------------------

    RESOLVED = ("people", "doctors", "claims", "procedures", "stays", "links")

    def run(self, layer: str, day: str, sources: Sequence[str] | None = None, steps: Sequence[str] | None = None, force: bool = False, maintain: bool = True) -> dict[str, str]:
        """Runs a layer, or all in order, for a logical date; outcome by batch. A step that failed ends the run; those done
        before are skipped the next time unless forced."""
        out = {}
        for one in LAYERS if layer == "all" else (layer,):
            if one == "raw":
                for n in sorted(sources or self.contracts):
                    out[f"raw.{n}"] = ingest(self.store, self.registry, self.contracts[n], f"{self.settings['landing']}/{n}", day, force)
            elif one == "resolved":
                unknown = set(steps or ()) - set(self.RESOLVED)
                if unknown:
                    raise ValueError(f"no such steps: {sorted(unknown)}")
                for n in self.RESOLVED:
                    if not steps or n in steps:
                        out[f"resolved.{n}"] = self.registry.run(day, "resolved", n, lambda _, f=getattr(self, n): f(day), force)
            elif one == "star":
                out["star"] = self.registry.run(day, "star", "all", lambda _: self.star(day), force)
                if maintain:
                    for n in ("fact_patient_visit", "fact_claim_lifecycle", "fact_bed_occupancy"):
                        self.store.vacuum(f"star/{n}", 2)
            else:
                out["quality"] = self.registry.run(day, "quality", "all", lambda _: self.quality(day), force)
        return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarrylake", description="Runs the layers of a network's data, exports panels, checks a store.")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run")
    r.add_argument("layer", choices=(*LAYERS, "all"))
    r.add_argument("--root", required=True)
    r.add_argument("--config", action="append", default=[], help="TOML file; later ones win")
    r.add_argument("--date", default=date.today().isoformat())
    r.add_argument("--sources", nargs="*")
    r.add_argument("--steps", nargs="*")
    r.add_argument("--force", action="store_true")
    r.add_argument("--no-fail-on-quality", action="store_true")
    r.add_argument("--skip-maintenance", action="store_true")
    e = sub.add_parser("export", help="JSON panels of the questions over the tables of a folder")
    e.add_argument("--tables", required=True)
    e.add_argument("--out", required=True)
    q = sub.add_parser("report", help="questions as Markdown")
    q.add_argument("--tables", required=True)
    q.add_argument("--only", nargs="*")
    q.add_argument("--out")
    c = sub.add_parser("check", help="whether a store below the folder works")
    c.add_argument("--root", required=True)
    return p


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if all went well, 1 if not. The session is the caller's or the active one."""
    from ..plans import questions
    from ..sources.sinks import write_panels, write_text

    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    try:
        if a.command == "run":
            settings = config.load(*a.config, {"quality": {"fail": not a.no_fail_on_quality}})
            done = Pipeline(spark, a.root, settings).run(a.layer, a.date, a.sources, a.steps, a.force, not a.skip_maintenance)
            print("\n".join(f"{k}: {v}" for k, v in done.items()))
        elif a.command == "export":
            print("\n".join(write_panels(a.out, questions.panels(spark, a.tables), {"run": uuid.uuid4().hex})))
        elif a.command == "report":
            text = questions.report(spark, a.tables, a.only)
            if a.out:
                write_text(spark, a.out, text)
            else:
                print(text)
        else:
            found = self_check(spark, a.root)
            print("\n".join(f"{k}: {'ok' if v else 'FAILED'}" for k, v in found.items()))
            return 0 if all(found.values()) else 1
    except Exception as e:  # noqa: BLE001  the outcome is the exit code
        print(f"failed: {e}", file=sys.stderr)
        return 1
    return 0
