"""Names, code lists and lookup tables that outputs must carry."""

from __future__ import annotations

from cohortal.config import ConditionRule


def _codes(letter: str, first: int, last: int) -> list[str]:
    return [f"{letter}{n:02d}" for n in range(first, last + 1)]


# Diagnosis families of the two outcomes.
CANCER = ConditionRule("cancer", include=("C",), exclude=("C44",))
STROKE = ConditionRule("stroke", include=("I6",))

# Named code groups, as LIKE patterns.
NAMED_GROUPS = {
    "digestive_system_diseases": ["K%"],
    "family_history_cancer": ["Z80%"],
}

# Three-character codes of each disease site. Sites may overlap.
SITE_CODES = {
    "head_and_neck": [*_codes("C", 0, 14), "C30", "C31", "C32"],
    "gi_upper_and_lower": _codes("C", 15, 26),
    "lung": ["C33", "C34", "C37", "C38", "C39", "C45"],
    "sarcoma": ["C40", "C41", "C46", "C48", "C49"],
    "melanoma": ["C43"],
    "brain_and_cns": ["C47", "C69", "C70", "C71", "C72"],
    "breast": ["C50"],
    "gynae": _codes("C", 51, 58),
    "urology": _codes("C", 60, 68),
    "endocrine": ["C73", "C74", "C75"],
    "haematological": _codes("C", 81, 96),
    "unknown": [*_codes("C", 76, 80), "C97"],
    "ovarian": ["C56"],
    "pancreatic": ["C25"],
    "bladder": ["C67"],
    "myeloma": ["C90"],
    "stomach": ["C16"],
    "oesophageal": ["C15"],
    "kidney": ["C64", "C65"],
    "lymphoma": _codes("C", 81, 86),
}

# Code that marks a referral to a service, not a diagnosis.
NOT_A_DIAGNOSIS = "#NIS"

# Columns of the raw outpatient table that hold diagnosis codes.
OUTPATIENT_CODE_COLUMNS = [
    "Primary_Diagnosis_Code",
    *[f"Secondary_Diagnosis_Code_{n}" for n in range(1, 24)],
]
FIRST_FINANCIAL_YEAR = "2016/2017"

# Cause-of-death columns of the mortality table.
CAUSE_COLUMNS = ["s_underlying_cod_icd10", *[f"s_cod_code_{n}" for n in range(1, 16)]]

# Columns kept from the emergency code map.
CODE_MAP_COLUMNS = [
    "ECDS_UniqueID", "ECDS_Group1", "ECDS_Group2", "ECDS_Group3",
    "ECDS_Description", "ECDS_SearchTerms",
    "SNOMED_Code", "SNOMED_UK_Preferred_Term", "SNOMED_Fully_Specified_Name",
    "Flag_Injury", "Flag_NotifiableDisease", "Flag_Male", "Flag_Female",
    "Flag_Allergy", "Flag_SDEC", "Flag_ADS",
    "Notes", "Valid_From", "Valid_To",
    "ICD10_Mapping", "ICD10_Description", "ICD11_Mapping", "ICD11_Description",
]

# Person columns turned into 0/1 columns.
PERSON_CATEGORIES = [
    "gender", "ethnicity_code", "imd_decile", "acorn_household_type",
    "acorn_wellbeing_type", "rural_urban_classification", "ccg_of_residence",
]
PERSON_BOOLEANS = [
    "living_alone", "living_with_young", "living_with_elderly", "private_outdoor_space",
]
TRISTATE = ["False", "Unknown", "True"]
GENDERS = ["Female", "Not known", "Not specified", "Male"]
ETHNICITIES = [
    "K", "F", "99", "E", "B", "L", "M", "D", "C", "J", "A", "N", "X", "S", "R", "G", "P", "H",
]
DECILES = ["7", "3", "8", "unknown", "5", "6", "9", "1", "10", "4", "2"]

# Geography columns, snapshot categories and region names.
GEOGRAPHY_COLUMNS = ["cancer_alliance", "integrated_care_board"]
SNAPSHOT_CATEGORIES = ["nhs_region", "stp_code"]
REGIONS = [
    "North West", "unknown", "London", "South East", "East of England",
    "North East and Yorkshire", "South West", "Midlands",
]

# Columns carried from the health-record snapshot, in their order.
SNAPSHOT_COLUMNS = [
    "date",
    "date_of_birth",
    "date_of_death",
    "healthy_well",
    "ltc",
    "disability",
    "frailty_dementia",
    "organ_failure",
    "incurable_cancer",
    "highest_acuity_segment_code",
    "highest_acuity_segment_name",
    "highest_acuity_segment_description",
    "maternal_and_infant_health",
    "alcohol_dependence",
    "asthma",
    "atrial_fibrillation",
    "bronchiectasis",
    "cancer",
    "cerebrovascular_disease",
    "chronic_kidney_disease",
    "chronic_liver_disease",
    "chronic_pain",
    "copd",
    "coronary_heart_disease",
    "cystic_fibrosis",
    "depression",
    "diabetes",
    "epilepsy",
    "heart_failure",
    "hypertension",
    "inflammatory_bowel_disease",
    "multiple_sclerosis",
    "osteoarthritis",
    "osteoporosis",
    "parkinsons_disease",
    "peripheral_vascular_disease",
    "pulmonary_heart_disease",
    "rheumatoid_arthritis",
    "sarcoidosis",
    "serious_mental_illness",
    "sickle_cell_disease",
    "autism",
    "learning_disability",
    "physical_disability",
    "dementia",
    "intermediate_frailty_risk_hfrs",
    "high_frailty_risk_hfrs",
    "end_stage_renal_failure",
    "severe_interstitial_lung_disease",
    "liver_failure",
    "neurological_organ_failure",
    "severe_copd",
    "severe_heart_failure",
    "immunocompromised",
    "spleen_problems",
    "active_cancer",
    "active_lung_cancer",
    "blood_and_bone_marrow_cancer",
    "bone_marrow_and_stem_cell_transplants",
    "organ_transplants",
    "downs_syndrome",
    "rare_diseases",
    "palliative_care",
    "obesity",
    "other_chronic_respiratory_diseases",
    "pulmonary_embolism",
    "congenital_heart_disease",
    "severe_asthma",
    "cerebral_palsy",
    "other_chronic_neurological_diseases",
]
SNAPSHOT_DATES = ["date", "date_of_birth", "date_of_death"]
SNAPSHOT_SEGMENTS = [
    "highest_acuity_segment_code",
    "highest_acuity_segment_name",
    "highest_acuity_segment_description",
]
SNAPSHOT_FLAGS = [
    c for c in SNAPSHOT_COLUMNS if c not in SNAPSHOT_DATES and c not in SNAPSHOT_SEGMENTS
]
# Snapshot columns of the modelling table, in their order, before and after
# the snapshot's categories.
MODEL_SNAPSHOT_FIRST = [
    "date",
    "date_of_birth",
    "healthy_well",
    "ltc",
    "disability",
    "frailty_dementia",
    "organ_failure",
    "incurable_cancer",
    "highest_acuity_segment_code",
    "highest_acuity_segment_name",
    "highest_acuity_segment_description",
]
MODEL_SNAPSHOT_LAST = [
    "hypertension",
    "depression",
    "diabetes",
    "asthma",
    "osteoarthritis",
    "coronary_heart_disease",
    "cancer",
    "date_of_death",
    "atrial_fibrillation",
    "cerebrovascular_disease",
    "osteoporosis",
    "copd",
    "obesity",
    "heart_failure",
    "immunocompromised",
    "peripheral_vascular_disease",
    "chronic_kidney_disease",
    "dementia",
    "chronic_pain",
    "intermediate_frailty_risk_hfrs",
    "palliative_care",
    "high_frailty_risk_hfrs",
    "serious_mental_illness",
    "physical_disability",
    "severe_heart_failure",
    "epilepsy",
    "pulmonary_heart_disease",
    "rheumatoid_arthritis",
    "severe_copd",
    "alcohol_dependence",
    "chronic_liver_disease",
    "inflammatory_bowel_disease",
    "other_chronic_respiratory_diseases",
    "severe_asthma",
    "pulmonary_embolism",
    "learning_disability",
    "congenital_heart_disease",
    "blood_and_bone_marrow_cancer",
    "bronchiectasis",
    "end_stage_renal_failure",
    "liver_failure",
    "parkinsons_disease",
    "autism",
    "active_cancer",
    "neurological_organ_failure",
    "spleen_problems",
    "severe_interstitial_lung_disease",
    "rare_diseases",
    "organ_transplants",
    "multiple_sclerosis",
    "other_chronic_neurological_diseases",
    "cerebral_palsy",
    "sarcoidosis",
    "active_lung_cancer",
    "downs_syndrome",
    "sickle_cell_disease",
    "bone_marrow_and_stem_cell_transplants",
    "cystic_fibrosis",
]
# Snapshot columns that stay null for a person without a snapshot.
SNAPSHOT_NOT_FILLED = [
    *SNAPSHOT_DATES, *SNAPSHOT_SEGMENTS,
    "nhs_region_id", "nhs_region_null_removed", "stp_code_null_removed",
]

# Call symptom labels of the modelling table, already sanitised.
SYMPTOM_LABELS = [
    "Abdominal_Pain",
    "Abdominal_Pain__Pregnant__Over_20_Weeks",
    "Abdominal_Pain__Rectal_Bleeding__Pregnant_Over_20_Weeks",
    "Abdominal__Flank__Groin_or_Back_Pain_or_Swelling",
    "Blood_in_Urine",
    "Breast_Lump",
    "Breast_Lump__Pregnant",
    "Breathing_Problems__Breathlessness_or_Wheeze",
    "Breathing_Problems__Breathlessness_or_Wheeze__Pregnant",
    "Chest_and_Upper_Back_Pain",
    "Constipation",
    "Cough",
    "Coughing_up_Blood",
    "Diarrhoea",
    "Diarrhoea_and_Vomiting",
    "Difficulty_Passing_Urine",
    "ED_Triage_Chest_Pain",
    "Easy_or_Unexplained_Bruising",
    "Face__Neck_Pain_or_Swelling",
    "Fever",
    "Genital_Problems",
    "Itch",
    "Mouth_Ulcers",
    "Pain_and/or_Frequency_Passing_Urine",
    "Rectal_Bleeding",
    "Rectal_Pain__Swelling__Lump_or_Itch",
    "Skin_Lumps",
    "Skin_Problems",
    "Tiredness__Fatigue_",
    "Urinary_Problems",
    "Vaginal_Bleeding",
    "Vaginal_Discharge",
    "Vomiting",
    "Vomiting_Blood",
]

# Category regroupings of the modelling table.
RURAL_URBAN = {
    "Rural town and fringe in a sparse setting": "rural",
    "Rural town and fringe": "rural",
    "Rural hamlets and isolated dwellings": "rural",
    "unknown": "unknown",
    "Urban city and town in a sparse setting": "urban",
    "Urban city and town": "urban",
    "Rural hamlets and isolated dwellings in a sparse setting": "rural",
    "Urban minor conurbation": "urban",
    "Rural village in a sparse setting": "rural",
    "Rural village": "rural",
    "Urban major conurbation": "urban",
}
# Household types 1-62 fall into groups by range: (first, last, group).
_HOUSEHOLD_RANGES = [
    (1, 11, "1"), (12, 21, "2"), (22, 32, "3"), (33, 46, "4"),
    (47, 57, "5"), (58, 59, "unknown"), (60, 62, "6"),
]
HOUSEHOLD_TYPE = {
    str(n): group for first, last, group in _HOUSEHOLD_RANGES for n in range(first, last + 1)
} | {"unknown": "unknown"}
RURAL_URBAN_GROUPS = ["rural", "unknown", "urban"]
HOUSEHOLD_GROUPS = ["1", "2", "3", "4", "5", "6", "unknown"]

# Exclusion reasons.
NO_AGE = "no valid age"
TOO_YOUNG = "age <40"
TOO_OLD = "age > 120"
RECORD_FLAG = "PHR flag of active or previous cancer"
PRIOR_CANCER = "Previous cancer flag from SUS"
PRIOR_STROKE = "Previous stroke flag from SUS"
DIED_BEFORE = "passed away before cut-off"
DEDUCTED = "deduction reason (not death)"
DIED_AFTER = "passed away after cut-off (without cancer as COD)"

# The category whose flag the modelling table carries.
FAMILY_HISTORY_CATEGORY = "Z80-Z99"

DEATH_LABEL = "first_cancer_diagnosis_at_death_after_cut_off"


def model_columns(cfg, *, death_label: bool = True) -> list[str]:
    """Columns of the modelling table in their order, built from the naming rules above."""
    n = cfg.label_weeks
    last = f"last_{n}_weeks"
    before = "cancer_before_cut_off"
    clean = "_null_removed"
    tristate = PERSON_BOOLEANS[:3]
    names = [cfg.entity, "111_calls_total", f"111_calls_{last}", f"111_calls_cancer_{last}"]
    names += [f"{label}_111_calls_{last}" for label in SYMPTOM_LABELS]
    names += ["ae_attend_total", f"ae_attendances_{last}", f"{before}_binary"]
    names += [f"{before}_in_last_{w}_weeks" for w in cfg.lookback_weeks]
    names += [before, f"{before}_date_earliest", f"{before}_date_latest"]
    for total, windowed in (("IP", "IP"), ("opa", "OPA")):
        names += [
            f"{total}_attend_total", f"{windowed}_attendances_{last}",
            f"{total}_diagnoses_total", f"{total}_diagnosis_pct_of_attendnaces",
        ]
    names += ["all_cancer_diagnoses_after_cut_off"]
    names += [f"cancer_diagnosis_in_next_{w}_weeks" for w in cfg.horizon_weeks]
    for end in ("earliest", "latest"):
        names += [f"cancer_after_cut_off_date_{end}", f"diagnosis_{end}_after_cut_off_date"]
    names += [
        "care_home", "registered_with_closed_practice", "diabetes", "immunocompromised",
        "ethnicity_code", "gender", "imd_decile", "acorn_type",
    ]
    cleaned = [*tristate, "gender", "ethnicity_code", "imd_decile", "rural_urban_classification"]
    names += [c + clean for c in cleaned]
    names += ["death_month"]
    one_hot = [(c, TRISTATE) for c in tristate]
    one_hot += [("gender", GENDERS), ("ethnicity_code", ETHNICITIES), ("imd_decile", DECILES)]
    names += [f"{c}{clean}_{v.replace(' ', '_')}" for c, values in one_hot for v in values]
    names += [f"acorn_household_type{clean}", "age_clean"]
    names += [f"phr_{c}" for c in MODEL_SNAPSHOT_FIRST]
    names += [f"phr_{c}{clean}" for c in SNAPSHOT_CATEGORIES]
    names += [f"phr_nhs_region{clean}_{v.replace(' ', '_')}" for v in REGIONS]
    names += [f"phr_{c}" for c in MODEL_SNAPSHOT_LAST]
    names += [f"{FAMILY_HISTORY_CATEGORY}_{last}"]
    return names + [DEATH_LABEL] if death_label else names
