"""Outcome labels after the cut-off."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortal.config import CohortConfig, ConditionRule
from cohortal.fixed import DEATH_LABEL
from cohortal.functions.weeks import Timeline, flag
from cohortal.operators.dictionary import CodeDictionary, packable
from cohortal.operators.summary import DATE, SPAN, code_spans, first_and_last


def label_spans(
    spans: DataFrame,
    cfg: CohortConfig,
    condition: str,
    *,
    prefix: str = "",
    anchor: str = "earliest",
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """``outcome_labels`` over spans keyed by person."""
    ends = first_and_last(spans, [cfg.entity], with_codes=True, dictionary=dictionary, **SPAN)
    return _labels(ends, cfg, condition, prefix, anchor)


def _labels(
    ends: DataFrame, cfg: CohortConfig, condition: str, prefix: str, anchor: str
) -> DataFrame:
    date = f"{prefix}{condition}_after_cut_off_date"
    code = prefix + "diagnosis_{}_after_cut_off_date"
    out = ends.select(
        cfg.entity,
        F.col("first.date").alias(f"{date}_earliest"),
        F.col("first.code").alias(code.format("earliest")),
        F.col("last.date").alias(f"{date}_latest"),
        F.col("last.code").alias(code.format("latest")),
        F.col("codes").alias(f"{prefix}all_{condition}_diagnoses_after_cut_off"),
    )
    line = Timeline(out, cfg, f"{date}_{anchor}")
    flags = [
        flag(line.by(n)).alias(f"{prefix}{condition}_diagnosis_in_next_{n}_weeks")
        for n in cfg.horizon_weeks
    ]
    return out.select("*", *flags)


def outcome_labels(
    events: DataFrame,
    cfg: CohortConfig,
    condition: str,
    *,
    prefix: str = "",
    anchor: str = "earliest",
    dictionary: CodeDictionary | None = None,
) -> DataFrame:
    """Per person: first and latest date and code, code set, and one flag per horizon.

    ``events`` are already limited to the condition and to dates after the
    cut-off. Flags look at the earliest date, or the latest with
    ``anchor="latest"``. With a literal ``dictionary`` events are aggregated in one shuffle,
    else they become spans first.
    """
    if dictionary is not None and dictionary.codes is not None and packable(events, DATE):
        ends = first_and_last(events, [cfg.entity], with_codes=True, dictionary=dictionary)
        return _labels(ends, cfg, condition, prefix, anchor)
    spans = code_spans(events, [cfg.entity])
    return label_spans(spans, cfg, condition, prefix=prefix, anchor=anchor)


def flag_cause_of_death(
    person: DataFrame, rule: ConditionRule, causes: list[str], out: str
) -> DataFrame:
    """1 if any cause column holds a code of the family."""
    return person.withColumn(out, rule.any_of(causes))


def update_labels_from_death(
    person: DataFrame,
    cfg: CohortConfig,
    *,
    death: str = "death_month",
    cause_flag: str = "passed_away_with_cancer_cod",
    codes: str = "all_cancer_diagnoses_after_cut_off",
    label: str = "cancer_diagnosis_in_next_{}_weeks",
) -> DataFrame:
    """Raise horizon labels for people first diagnosed on the death certificate.

    That is: the condition is a cause of death, no code was seen after the
    cut-off, and death lies strictly after it.
    """
    line = Timeline(person, cfg, death)
    at_death = (F.col(cause_flag) == 1) & F.col(codes).isNull() & line.after()
    person = person.withColumn(DEATH_LABEL, flag(at_death))
    horizon = {
        f"death_with_first_cancer_diagnosis_in_next_{n}_weeks": flag(
            line.by(n) & (F.col(DEATH_LABEL) == 1)
        )
        for n in cfg.horizon_weeks
    }
    person = person.withColumns(horizon)
    raised = {
        label.format(n): flag((F.col(by_death) == 1) | (F.col(label.format(n)) == 1))
        for n, by_death in zip(cfg.horizon_weeks, horizon)
    }
    return person.withColumns(raised)
