"""The whole job, from a folder of tables to the written results."""

from __future__ import annotations

import os
from dataclasses import fields, replace

import pytest

from cohortal import fixed, job
from cohortal.plans.build import Sources
from cohortal.sources.tables import staging_folder
from registry import adapters

ID = "patient_pseudo_id"
CFG = replace(adapters.CFG, seed=7)
YEAR = f"last_{CFG.label_weeks}_weeks"
# Columns that each dataset must carry.
COLUMNS = {
    "outpatient_raw": {"OPA_Ident", *fixed.OUTPATIENT_CODE_COLUMNS},
    "outpatient_with_codes": {ID, "activity_id", *fixed.OUTPATIENT_CODE_COLUMNS},
    "emergency_code_map": set(fixed.CODE_MAP_COLUMNS),
    "emergency_codes": {ID, "date", "diagnosis", "source", "SNOMED_Code"},
    "inpatient_codes": {ID, "date", "diagnosis", "source"},
    "outpatient_codes": {ID, "date", "diagnosis", "source"},
    "combined_codes": {ID, "date", "diagnosis", "source", "category_3_code"},
    "emergency_features": {ID, "ae_attend_total"},
    "inpatient_features": {ID, "IP_attend_total"},
    "outpatient_features": {ID, "opa_attend_total"},
    "call_features": {ID, "111_calls_total"},
    "snapshot_features": {ID, *fixed.SNAPSHOT_COLUMNS},
    "geography": {ID, *fixed.GEOGRAPHY_COLUMNS},
    "category_features": {ID, f"{fixed.FAMILY_HISTORY_CATEGORY}_{YEAR}"},
    "prior_cancer": {ID, "cancer_before_cut_off_binary"},
    "cancer_outcome": {ID, "cancer_after_cut_off_date_earliest"},
    "site_outcomes": {ID},
    "person_features": {ID, "age", "cancer_before_cut_off_binary"},
    "person_features_expanded": {ID, "age_clean", "phr_cancer", "IP_attend_total"},
    "cancer_exclusions": {ID, "reason"},
    "cancer_cohort": {ID, fixed.DEATH_LABEL},
    "cancer_table": {*fixed.model_columns(CFG), "category", "dataset"},
    "prior_stroke": {ID, "stroke_before_cut_off_binary"},
    "stroke_outcome": {ID, "stroke_after_cut_off_date_earliest"},
    "stroke_exclusions": {ID, "reason"},
    "stroke_cohort": {ID, "age_clean"},
    "stroke_table": {*fixed.model_columns(CFG, death_label=False), "category", "dataset"},
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    made = adapters.sources(spark, "/root/testdata/sf0.001")
    folder = tmp_path_factory.mktemp("sources")
    for f in fields(Sources):
        getattr(made, f.name).write.parquet(str(folder / f"{f.name}.parquet"))
    return str(folder)


def staged(spark) -> set[str]:
    folder = staging_folder(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_job_writes_every_dataset_and_leaves_nothing_staged(spark, folder, tmp_path):
    before, out = staged(spark), str(tmp_path)
    job.run(spark, folder, out, CFG)
    assert staged(spark) == before
    assert set(os.listdir(out)) == set(COLUMNS)
    tables = {name: spark.read.parquet(f"{out}/{name}") for name in COLUMNS}
    for name, columns in COLUMNS.items():
        assert columns <= set(tables[name].columns), name
    for outcome in ("cancer", "stroke"):
        kept, listed = tables[f"{outcome}_cohort"], tables[f"{outcome}_exclusions"]
        assert kept.join(listed, ID, "left_semi").count() == 0
        people = tables["person_features_expanded"].count()
        assert kept.count() + listed.select(ID).distinct().count() == people
    # The columns of the stratum come first, the others in the order of the contract.
    first = {"gender", f"cancer_diagnosis_in_next_{CFG.label_weeks}_weeks"}
    contract = [c for c in fixed.model_columns(CFG) if c not in first]
    assert [c for c in tables["cancer_table"].columns if c in set(contract)] == contract


def test_job_writes_only_what_is_named(spark, folder, tmp_path):
    job.run(spark, folder, str(tmp_path), CFG, only=["geography"])
    assert os.listdir(tmp_path) == ["geography"]
    with pytest.raises(ValueError, match="no such datasets"):
        job.run(spark, folder, str(tmp_path), CFG, only=["geografy"])
