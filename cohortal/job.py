"""Build every dataset from a folder of Parquet tables.

    spark-submit cohortal/job.py --sources FOLDER --out FOLDER [--cutoff 2021-08-31]
                                 [--only cancer_table,stroke_table]

``FOLDER`` holds one table per field of ``Sources``, e.g. ``person.parquet``. The
session's ``spark.checkpoint.dir`` names the shared folder for staged tables; they are
removed when the job ends.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from cohortal import fixed
from cohortal.config import CohortConfig
from cohortal.operators.longlist import row_hash
from cohortal.plans import build, codes, cohort, exclusions, features
from cohortal.sources.tables import stage, stage_bucketed, staged_run, write_table


class Datasets:
    """The datasets by name. Tables that several of them start from are staged once, when
    the first of them is asked for."""

    def __init__(self, sources: build.Sources, cfg: CohortConfig):
        self.s, self.cfg = sources, cfg
        # Snapshots of one day: any fixed order will do, and a short one sorts faster.
        self.tie_break = [row_hash(sources.snapshots)]

    @cached_property
    def ready(self) -> build.Prepared:
        return build.prepare(self.s, self.cfg)

    @cached_property
    def people(self) -> DataFrame:
        return build.stage_people(self.ready, self.cfg, tie_break=self.tie_break)

    @cached_property
    def expanded(self) -> DataFrame:
        wide = build.wide_person(
            self.ready, self.cfg, categories=self.categories, tie_break=self.tie_break
        )
        return stage_bucketed(wide, "expanded", self.cfg.entity)

    @cached_property
    def categories(self) -> list[str]:
        return build.past_categories(self.ready, self.cfg)

    @cached_property
    def raw(self) -> DataFrame:
        return codes.union_periods(self.s.outpatient_periods)

    @cached_property
    def outpatient(self) -> DataFrame:
        return stage(codes.outpatient_with_codes(self.s.outpatient, self.raw), "outpatient")

    @cached_property
    def code_map(self) -> DataFrame:
        return stage(codes.emergency_code_map(self.s.code_map, self.s.fallback_map), "code_map")

    def code_rows(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        return (
            codes.inpatient_code_rows(self.s.inpatient, self.cfg),
            codes.outpatient_code_rows(self.outpatient, self.cfg),
            codes.emergency_code_rows(self.s.emergency, self.code_map, self.cfg),
        )

    def person_features(self) -> DataFrame:
        ready, cfg = self.ready, self.cfg
        return cohort.person_features(
            self.s.person,
            build.condition_outcome(ready, cfg, fixed.CANCER),
            build.category_features(ready, cfg, self.categories),
            build.prior_condition(ready, cfg, fixed.CANCER),
            cfg,
        )

    def cancer_cohort(self) -> DataFrame:
        listed = build.cancer_exclusions(self.ready, self.expanded, self.cfg)
        return cohort.cancer_cohort(self.expanded, listed, self.cfg)

    def stroke_cohort(self) -> DataFrame:
        listed = build.stroke_exclusions(self.ready, self.expanded, self.cfg)
        return cohort.stroke_cohort(self.expanded, listed, self.cfg)

    def builders(self) -> dict[str, Callable[[], DataFrame]]:
        s, cfg = self.s, self.cfg
        return {
            "outpatient_raw": lambda: self.raw,
            "outpatient_with_codes": lambda: self.outpatient,
            "emergency_code_map": lambda: self.code_map,
            "emergency_codes": lambda: codes.emergency_codes(s.emergency, self.code_map, cfg),
            "inpatient_codes": lambda: codes.inpatient_codes(s.inpatient, cfg),
            "outpatient_codes": lambda: codes.outpatient_codes(self.outpatient, cfg),
            "combined_codes": lambda: codes.combined_codes(
                *self.code_rows(), s.code_reference, cfg
            ),
            "emergency_features": lambda: features.emergency_features(s.emergency, cfg),
            "inpatient_features": lambda: features.inpatient_features(s.inpatient, cfg),
            "outpatient_features": lambda: features.outpatient_features(self.outpatient, cfg),
            "call_features": lambda: features.call_features(s.calls, s.symptoms, cfg),
            "snapshot_features": lambda: features.snapshot_features(
                s.snapshots, cfg, tie_break=self.tie_break
            ),
            "geography": lambda: features.geography_features(
                s.boards, s.alliances, s.person, cfg
            ),
            "category_features": lambda: build.category_features(
                self.ready, cfg, self.categories
            ),
            "prior_cancer": lambda: build.prior_condition(self.ready, cfg, fixed.CANCER),
            "cancer_outcome": lambda: build.condition_outcome(self.ready, cfg, fixed.CANCER),
            "site_outcomes": lambda: build.site_outcomes(self.ready, cfg),
            "person_features": self.person_features,
            "person_features_expanded": lambda: self.expanded,
            "cancer_exclusions": lambda: exclusions.cancer_list(s, cfg, tie_break=self.tie_break),
            "cancer_cohort": self.cancer_cohort,
            "cancer_table": lambda: build.cancer_table(self.ready, self.people, cfg),
            "prior_stroke": lambda: build.prior_condition(self.ready, cfg, fixed.STROKE),
            "stroke_outcome": lambda: build.condition_outcome(self.ready, cfg, fixed.STROKE),
            "stroke_exclusions": lambda: exclusions.stroke_list(s, cfg),
            "stroke_cohort": self.stroke_cohort,
            "stroke_table": lambda: build.stroke_table(self.ready, self.people, cfg),
        }


def run(
    spark: SparkSession,
    sources: str,
    out: str,
    cfg: CohortConfig,
    only: Iterable[str] | None = None,
) -> None:
    """Write the named datasets, by default all of them, each under its own name."""
    with staged_run(spark):
        builders = Datasets(build.Sources.read(spark, sources), cfg).builders()
        unknown = sorted(set(only or []) - set(builders))
        if unknown:
            raise ValueError(f"no such datasets: {unknown}")
        for name in only or builders:
            write_table(builders[name](), f"{out}/{name}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--sources", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--cutoff", default=CohortConfig.cutoff)
    parser.add_argument("--seed", type=int, default=CohortConfig.seed)
    parser.add_argument("--only", help="names of datasets, separated by commas")
    args = parser.parse_args()
    cfg = CohortConfig(cutoff=args.cutoff, seed=args.seed)
    only = args.only.split(",") if args.only else None
    spark = SparkSession.builder.appName("cohortal").getOrCreate()
    run(spark, args.sources, args.out, cfg, only)


if __name__ == "__main__":
    main()
