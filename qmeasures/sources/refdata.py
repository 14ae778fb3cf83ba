"""Shipped reference values.

FIXED VALUES: the rows below must equal the published reference lists (measure
abbreviations in their file order, the dental taxonomy allow-list, and the
value-set -> component mappings); results depend on them verbatim.
"""

from __future__ import annotations

import csv
import os

# FIXED VALUES — measure abbreviation table, in file order (the order is the ordinal).
# columns: measure_abbreviation, measure_name, measure_format, measure_calculation_type
ABBREVIATIONS = [
    ("Alcohol_SBIRT", "Alcohol and Drug Misuse (SBIRT)", "#,##0.0%", "Binary"),
    ("ED_Visits_MI", "ED Utilization Among Members with Mental Illness", "#,##0.0", "Rate"),
    ("DHS_assessments", "Assessments within 60 Days for Children in DHS Custody", "#,##0.0%", "Binary"),
    ("Hypertension", "Controlling High Blood Pressure", "#,##0.0%", "Binary"),
    ("Diabetes_HbA1c", "Diabetes: HbA1c Poor Control", "#,##0.0%", "Binary"),
    ("Depression_Screening", "Screening for Clinical Depression and Follow-Up Plan", "#,##0.0%", "Binary"),
    ("Tobacco_Use", "Tobacco Use Prevalence", "#,##0.0%", "Binary"),
    ("Cigarette_Use", "Cigarette Use Prevalence", "#,##0.0%", "Binary"),
    ("Tobacco_Status", "Tobacco Use Status Recorded", "#,##0.0%", "Binary"),
    ("Childhood_Obesity_BMI", "Weight Assessment (BMI) in Children and Adolescents", "#,##0.0%", "Binary"),
    ("Childhood_Obesity_Nutr", "Counseling for Nutrition in Children and Adolescents", "#,##0.0%", "Binary"),
    ("Childhood_Obesity_Phys", "Counseling for Phys. Activity in Children and Adolescents", "#,##0.0%", "Binary"),
    ("BMI_Screening", "Body Mass Index (BMI) Screening and Follow-Up Plan", "#,##0.0%", "Binary"),
    ("SBIRT_Screen", "SBIRT - Screening", "#,##0.0%", "Binary"),
    ("SBIRT_Intervention", "SBIRT - Intervention and Follow-Up", "#,##0.0%", "Binary"),
    ("diabetes_oral_eval", "Oral Evaluation for Adults with Diabetes", "#,##0.0%", "Binary"),
    ("well_child_visits", "Well-Child Visits in the Third, Fourth, Fifth and Sixth Years of Life", "#,##0.0%", "Binary"),
    ("prev_dental_1_to_5", "Preventive Dental Services Ages 1-5", "#,##0.0%", "Binary"),
    ("prev_dental_6_to_14", "Preventive Dental Services Ages 6-14", "#,##0.0%", "Binary"),
    ("prenatal_care", "Prenatal Care", "#,##0.0%", "Binary"),
    ("postpartum_care", "Postpartum Care", "#,##0.0%", "Binary"),
    ("aod_init", "Initiation of Alcohol and Other Drug Abuse or Dependence Treatment", "#,##0.0%", "Binary"),
    ("aod_engage", "Engagement of Alcohol and Other Drug Abuse or Dependence Treatment", "#,##0.0%", "Binary"),
]

# FIXED VALUES — dental provider taxonomy allow-list.
DENTAL_TAXONOMY = [
    "122300000X", "1223D0001X", "1223D0004X", "1223E0200X", "1223G0001X", "1223P0106X",
    "1223P0221X", "1223P0300X", "1223P0700X", "1223S0112X", "1223X0008X", "1223X0400X",
    "124Q00000X", "125J00000X", "125K00000X", "125Q00000X", "261QF0400X", "261QR1300X",
]

# FIXED VALUES — value set -> component mapping per measure (medical code sets).
HEDIS_MAPPING = [
    ("diabetes_oral_eval", "Acute Inpatient", "acute_inpatient"),
    ("diabetes_oral_eval", "Telehealth Modifier", "telehealth_modifier"),
    ("diabetes_oral_eval", "Telehealth POS", "telehealth_pos"),
    ("diabetes_oral_eval", "Outpatient", "outpatient"),
    ("diabetes_oral_eval", "Observation", "observation"),
    ("diabetes_oral_eval", "ED", "ed"),
    ("diabetes_oral_eval", "Nonacute Inpatient", "nonacute_inpatient"),
    ("diabetes_oral_eval", "Diabetes", "diabetes"),
    ("diabetes_oral_eval", "Telephone Visits", "telephone_visits"),
    ("diabetes_oral_eval", "Online Assessments", "online_assessments"),
    ("diabetes_oral_eval", "Hospice Encounter", "hospice_encounter"),
    ("diabetes_oral_eval", "Hospice Intervention", "hospice_intervention"),
    ("diabetes_oral_eval", "Frailty Device", "frailty_device"),
    ("diabetes_oral_eval", "Frailty Diagnosis", "frailty_diagnosis"),
    ("diabetes_oral_eval", "Frailty Encounter", "frailty_encounter"),
    ("diabetes_oral_eval", "Frailty Symptom", "frailty_symptom"),
    ("diabetes_oral_eval", "Advanced Illness", "advanced_illness"),
    ("diabetes_oral_eval", "Diabetes Exclusions", "diabetes_exclusions"),
    ("well_child_visits", "Well-Care", "well_care"),
    ("well_child_visits", "Hospice Encounter", "hospice_encounter"),
    ("well_child_visits", "Hospice Intervention", "hospice_intervention"),
    ("well_child_visits", "Telehealth Modifier", "telehealth_modifier"),
    ("well_child_visits", "Telehealth POS", "telehealth_pos"),
    ("prenatal_postpartum_care", "Deliveries", "deliveries"),
    ("prenatal_postpartum_care", "Non-live Births", "non_live_births"),
    ("prenatal_postpartum_care", "Hospice Encounter", "hospice_encounter"),
    ("prenatal_postpartum_care", "Hospice Intervention", "hospice_intervention"),
    ("prenatal_postpartum_care", "Prenatal Bundled Services", "prenatal_bundled"),
    ("prenatal_postpartum_care", "Stand Alone Prenatal Visits", "standalone_prenatal"),
    ("prenatal_postpartum_care", "Prenatal Visits", "prenatal_visits"),
    ("prenatal_postpartum_care", "Pregnancy Diagnosis", "pregnancy_diagnosis"),
    ("prenatal_postpartum_care", "Postpartum Visits", "postpartum_visits"),
    ("prenatal_postpartum_care", "Cervical Cytology Lab Test", "cervical_cytology_lab"),
    ("prenatal_postpartum_care", "Cervical Cytology Result or Finding", "cervical_cytology_result"),
    ("prenatal_postpartum_care", "Postpartum Bundled Services", "postpartum_bundled"),
    ("prenatal_postpartum_care", "Acute Inpatient", "acute_inpatient"),
    ("prenatal_postpartum_care", "Acute Inpatient POS", "acute_inpatient_pos"),
    ("aod", "Alcohol Abuse and Dependence", "alc_abuse_dependence"),
    ("aod", "AOD Abuse and Dependence", "aod_abuse_dependence"),
    ("aod", "AOD Medication Treatment", "aod_med_treatment"),
    ("aod", "Detoxification", "detox"),
    ("aod", "ED", "ED"),
    ("aod", "IET Visits Group 1", "iet_visits_grp_1"),
    ("aod", "IET POS Group 1", "iet_pos_grp_1"),
    ("aod", "IET Visits Group 2", "iet_visits_grp_2"),
    ("aod", "IET POS Group 2", "iet_pos_grp_2"),
    ("aod", "IET Stand Alone Visits", "iet_standalone_visits"),
    ("aod", "Inpatient Stay", "ip_stay"),
    ("aod", "Observation", "observation"),
    ("aod", "Online Assessments", "online_assessments"),
    ("aod", "Opioid Abuse and Dependence", "opioid_abuse_dependence"),
    ("aod", "Other Drug Abuse and Dependence", "other_abuse_dependence"),
    ("aod", "Telephone Visits", "telephone_visits"),
    ("aod", "Hospice Encounter", "hospice_encounter"),
    ("aod", "Hospice Intervention", "hospice_intervention"),
]

# FIXED VALUES — medication list -> component mapping per measure.
MEDICATION_MAPPING = [
    ("diabetes_oral_eval", "Diabetes Medications", "diabetes_medications"),
    ("diabetes_oral_eval", "Dementia Medications", "dementia_medications"),
    ("aod", "Alcohol Use Disorder Treatment Medications", "alcohol_treatment_meds"),
    ("aod", "Opioid Use Disorder Treatment Medications", "opioid_treatment_meds"),
]

ABBREVIATION_HEADER = ["Measure_Abbreviation", "Measure_Description", "Measure_Format",
                       "Measure_Calculation_Type"]


def write_reference_files(folder: str) -> str:
    """Write the shipped reference tables as ``_data``/``_schemas`` CSV pairs under ``folder``.

    Used to seed a reference folder for :mod:`qmeasures.sources.reference` (and tests).
    """
    data = os.path.join(folder, "_data")
    schemas = os.path.join(folder, "_schemas")
    os.makedirs(data, exist_ok=True)
    os.makedirs(schemas, exist_ok=True)
    with open(os.path.join(data, "OHA_Abbreviations.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(ABBREVIATION_HEADER)
        w.writerows(ABBREVIATIONS)
    with open(os.path.join(schemas, "OHA_Abbreviations.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["name", "datatype", "nullable", "sas_informat"])
        w.writerows([("measure_abbreviation", "string", "false", "$24."),
                     ("measure_name", "string", "false", "$128."),
                     ("measure_format", "string", "false", "$16."),
                     ("measure_calculation_type", "string", "false", "$16.")])
    with open(os.path.join(data, "dental_taxonomy.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["taxonomy_code"])
        w.writerows([(c,) for c in DENTAL_TAXONOMY])
    with open(os.path.join(schemas, "dental_taxonomy.csv"), "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["name", "datatype", "nullable", "sas_informat"])
        w.writerow(("taxonomy_code", "string", "False", "$16."))
    return folder


def write_mapping_files(folder: str) -> tuple[str, str]:
    """Write the two mapping CSVs (header row + 3 columns) and return their paths."""
    os.makedirs(folder, exist_ok=True)
    hedis = os.path.join(folder, "hedis_measure_mapping.csv")
    meds = os.path.join(folder, "medication_measure_mapping.csv")
    with open(hedis, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["Measure", "Value Set Name", "Component"])
        w.writerows(HEDIS_MAPPING)
    with open(meds, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(["Measure", "Medication List Name", "Component"])
        w.writerows(MEDICATION_MAPPING)
    return hedis, meds
