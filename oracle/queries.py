"""Oracle SQL per query name (DuckDB)."""

from __future__ import annotations

from episcope.functions import fixed_values as fv
from episcope.plans.calendar import chunk_calendar

from .stages import STAGES, _chunk_case, _decode_provider, _in, _recode_case, _schedule_case, \
    _schedule_group_case, _tumour_case, _AGE_BAND, _FRACTIONATION, with_ctes

P0, P1 = fv.PERIOD_START, fv.PERIOD_END
DAY = "strftime({}, '%Y-%m-%d')"


def _day(c: str) -> str:
    return DAY.format(c)


_ETH = _recode_case("ETHNICITYNAME", fv.ETHNICITY_RECODE)
_ICB0 = "CASE WHEN ICB_HB IS NULL OR ICB_HB = '' THEN 'Postcode not matched' ELSE ICB_HB END"
_ICB = (f"replace(CASE WHEN ({_ICB0}) IN ({_in(fv.NON_ICB_AREAS)}) THEN 'Postcode not matched' "
        f"ELSE ({_ICB0}) END, ' Integrated Care Board', '')")

# Extra CTEs used only by operator queries.
STAGES["core_pairs"] = """
SELECT DISTINCT t.attendid, t.radiotherapyepisodeid, t.patientid, t.orgcodeprovider, t.treatmentstartdate, t.chunk_id,
 d.prescriptionid, d.rtprescribeddose, d.prescribedfractions, d.rttreatmentmodality, d.rttreatmentregion
FROM attendance t JOIN delivered d USING (attendid, radiotherapyepisodeid, patientid, orgcodeprovider)"""

STAGES["ep_patient"] = """
SELECT e.*, pa.birthdatebest, pa.sex,
 CAST(trunc(datediff('day', pa.birthdatebest, e.treatmentstartdate) / 365.25) AS INTEGER) AS tx_age
FROM at_episodes e LEFT JOIN at_patient pa ON e.patientid = pa.patientid"""

STAGES["eng_months"] = "SELECT * FROM eng_complete"

STAGES["to_gender"] = f"""
SELECT e.*, w.WORKING_DAYS,
 {_recode_case('INTENT', fv.INTENT_RECODE)} AS INTENT_R,
 {_recode_case('SEX', fv.GENDER_RECODE, keep=False)} AS GENDER
FROM eng_complete e LEFT JOIN wd_clean w ON e.CALENDAR_MONTH = w.CALENDAR_MONTH"""

_CAL_VALUES = ", ".join(f"({c.chunk_id}, '{c.start}', '{c.end}')" for c in chunk_calendar())

FINAL: dict[str, str] = {
    "published_table": "SELECT * FROM published",
    "extract": "SELECT * FROM extract",
    "scan_episodes": f"""
SELECT attendid, radiotherapyepisodeid, patientid, orgcodeprovider, {_day('treatmentstartdate')} AS treatmentstartdate,
 radiotherapyintent, radiotherapydiagnosisicd
FROM at_episodes WHERE treatmentstartdate BETWEEN DATE '{P0}' AND DATE '{P1}'""",
    "chunk_calendar": f"""
SELECT cal.chunk_id, cal.chunk_start, cal.chunk_end, r.n_rows, r.n_episodes
FROM (VALUES {_CAL_VALUES}) cal(chunk_id, chunk_start, chunk_end)
LEFT JOIN (SELECT chunk_id, count(*) AS n_rows, count(DISTINCT radiotherapyepisodeid) AS n_episodes
           FROM core_pairs GROUP BY chunk_id) r ON cal.chunk_id = r.chunk_id""",
    "qa_chunk_counts": f"""
SELECT {_chunk_case("CAST(strptime(CALENDAR_MONTH || '/01', '%Y/%m/%d') AS DATE)")} AS chunk_id, count(*) AS n_rows
FROM extract GROUP BY ALL""",
    "duplicate_episode_report": f"""
SELECT DISTINCT d.radiotherapyepisodeid, {_day('d.treatmentstartdate')} AS treatmentstartdate, d.patientid,
 d.orgcodeprovider, tr.trustname
FROM dup d LEFT JOIN trustsics tr ON tr.code = d.orgcodeprovider""",
    "working_days_clean": f"""
SELECT {_day('CALENDAR_MONTH')} AS calendar_month, WORKING_DAYS FROM wd_clean""",
    "provider_remap": f"""
SELECT orgcodeprovider, {_decode_provider('orgcodeprovider')} AS mapped_provider, count(*) AS n_rows
FROM at_episodes GROUP BY ALL""",
    "month_label": """
SELECT strftime(treatmentstartdate, '%Y/%m') AS calendar_month, count(*) AS n_rows FROM at_episodes GROUP BY ALL""",
    "age_at_event": "SELECT tx_age, count(*) AS n_rows FROM ep_patient GROUP BY ALL",
    "age_band": f"SELECT {_AGE_BAND} AS age, count(*) AS n_rows FROM ep_patient GROUP BY ALL",
    "sex_name": """
SELECT sex, CASE WHEN sex IN (0, NULL, 9) THEN 'Not Known/ Not Specified/Null' WHEN sex = 1 THEN 'Male'
 WHEN sex = 2 THEN 'Female' ELSE 'Unknown' END AS sexname, count(*) AS n_rows
FROM at_patient GROUP BY ALL""",
    "tumour_group": f"""
SELECT substr(e.radiotherapydiagnosisicd,1,3) AS icd3, p.rttreatmentregion,
 {_tumour_case('e.radiotherapydiagnosisicd', 'p.rttreatmentregion')} AS cancertype, count(*) AS n_rows
FROM at_episodes e JOIN at_prescriptions p ON e.attendid = p.attendid AND e.orgcodeprovider = p.orgcodeprovider
 AND e.radiotherapyepisodeid = p.radiotherapyepisodeid AND e.patientid = p.patientid
GROUP BY ALL""",
    "intent_rank": """
SELECT radiotherapyintent, CASE WHEN radiotherapyintent IN ('01') THEN 1 WHEN radiotherapyintent IN ('02') THEN 2
 WHEN radiotherapyintent IN ('03') THEN 3 ELSE 4 END AS ordered_intent, count(*) AS n_rows
FROM at_episodes GROUP BY ALL""",
    "home_area": "SELECT icb_hb, imd19_quintile_lsoas, count(*) AS n_rows FROM geo GROUP BY ALL",
    "intent_label": """
SELECT min_intent, CASE WHEN min_intent = 1 THEN 'PALLIATIVE' WHEN min_intent = 2 THEN 'RADICAL'
 ELSE 'OTHER/UNKNOWN' END AS intent, count(*) AS n_rows FROM rank1 GROUP BY ALL""",
    "fractionation_category": f"""
SELECT DISTINCT min_intent, CAST(max_dose AS DOUBLE) AS max_dose, max_fractions,
 {_FRACTIONATION} AS fractionation_category FROM rank1""",
    "schedule_label": f"""
SELECT DISTINCT cancertype, min_intent, CAST(max_dose AS DOUBLE) AS max_dose, max_fractions,
 {_schedule_case()} AS dose_fractionation_schedules FROM rank1""",
    "schedule_group": f"""
SELECT DISTINCT cancertype, min_intent, CAST(max_dose AS DOUBLE) AS max_dose, max_fractions,
 {_schedule_group_case()} AS schedule_group FROM rank1""",
    "provider_patch": """
SELECT ORGCODEPROVIDER, COUNTRY, PROVIDER_NAME, RT_NETWORK_NAME, CANCER_ALLIANCE_OLD, CANCER_ALLIANCE_NEW,
 count(*) AS n_rows FROM patched_handover GROUP BY ALL""",
    "month_parts": f"""
SELECT {_day("CAST(strptime(CALENDAR_MONTH || '/01', '%Y/%m/%d') AS DATE)")} AS calendar_month,
 CAST(substr(CALENDAR_MONTH, 1, 4) AS INTEGER) AS EPI_YEAR, CAST(substr(CALENDAR_MONTH, 6, 2) AS INTEGER) AS EPI_MONTH,
 count(*) AS n_rows FROM extract GROUP BY ALL""",
    "recode_intent": f"SELECT INTENT, {_recode_case('INTENT', fv.INTENT_RECODE)} AS INTENT_RECODED, count(*) AS n_rows FROM extract GROUP BY ALL",
    "recode_age": f"SELECT AGE, {_recode_case('AGE', fv.AGE_RECODE)} AS AGEGROUP, count(*) AS n_rows FROM extract GROUP BY ALL",
    "recode_gender": f"SELECT SEX, {_recode_case('SEX', fv.GENDER_RECODE, keep=False)} AS GENDER, count(*) AS n_rows FROM extract GROUP BY ALL",
    "recode_ethnicity": f"""
SELECT ETHNICITYNAME, CASE WHEN ({_ETH}) IS NULL OR ({_ETH}) = '' THEN 'Unknown' ELSE ({_ETH}) END AS ETHNICITY_GROUP,
 count(*) AS n_rows FROM extract GROUP BY ALL""",
    "deprivation_default": """
SELECT IMD19_QUINTILE_LSOAS, CASE WHEN IMD19_QUINTILE_LSOAS IS NULL OR IMD19_QUINTILE_LSOAS = '' THEN 'Unknown'
 ELSE IMD19_QUINTILE_LSOAS END AS DEPRIVATION, count(*) AS n_rows FROM extract GROUP BY ALL""",
    "icb_clean": f"SELECT ICB_HB, {_ICB} AS ICB, count(*) AS n_rows FROM extract GROUP BY ALL",
    "recode_tumour": f"SELECT CANCERTYPE, {_recode_case('CANCERTYPE', fv.TUMOUR_RECODE)} AS TUMOUR_GROUP, count(*) AS n_rows FROM extract GROUP BY ALL",
    "recode_category": f"""
SELECT FRACTIONATION_CATEGORY, {_recode_case('FRACTIONATION_CATEGORY', fv.CATEGORY_RECODE)} AS CATEGORY,
 count(*) AS n_rows FROM extract GROUP BY ALL""",
    "working_day_adjust": "SELECT DISTINCT episodeCount, wd, adjusted FROM published",
    "filter_period": f"""
SELECT attendid, radiotherapyepisodeid, {_day('treatmentstartdate')} AS treatmentstartdate
FROM at_episodes WHERE treatmentstartdate BETWEEN DATE '{P0}' AND DATE '{P1}'""",
    "filter_modality_or_machine": f"""
SELECT p.attendid, p.orgcodeprovider, p.radiotherapyepisodeid, p.patientid, p.prescriptionid, p.rttreatmentmodality
FROM at_prescriptions p WHERE EXISTS (
 SELECT 1 FROM at_exposures x WHERE p.orgcodeprovider = x.orgcodeprovider AND p.attendid = x.attendid
  AND p.radiotherapyepisodeid = x.radiotherapyepisodeid AND p.patientid = x.patientid
  AND p.prescriptionid = x.prescriptionid
  AND (p.rttreatmentmodality = '05' OR x.machineid IN ({_in(fv.ADMITTED_MACHINES)})))""",
    "filter_icd": f"""
SELECT attendid, radiotherapyepisodeid, radiotherapydiagnosisicd FROM at_episodes
WHERE substr(radiotherapydiagnosisicd,1,3) IN ({_in(fv.ICD_WHITELIST)})""",
    "drop_duplicate_episodes": """
SELECT attendid, radiotherapyepisodeid, patientid, orgcodeprovider FROM at_episodes ANTI JOIN dup
USING (radiotherapyepisodeid, treatmentstartdate, patientid, orgcodeprovider)""",
    "duplicate_episode_ids": "SELECT radiotherapyepisodeid FROM dup_ids",
    "filter_adult": f"""
SELECT DISTINCT radiotherapyepisodeid, orgcodeprovider AS mapped_provider,
 {_day('treatmentstartdate')} AS treatmentstartdate, patientid, tx_age, {_AGE_BAND} AS age
FROM core WHERE tx_age >= 18""",
    "best_address": f"""
SELECT {_day('treatmentstartdate')} AS treatmentstartdate, radiotherapyepisodeid, orgcodeprovider AS mapped_provider,
 min_intent, cancertype, CAST(max_dose AS DOUBLE) AS max_dose, max_fractions, age, ethnicity, ethnicityname, sex,
 sexname, calendar_month, addressid, icb_hb, imd19_quintile_lsoas
FROM rank1""",
    "filter_country": """
SELECT ORGCODEPROVIDER, COUNTRY, count(*) AS n_rows FROM patched WHERE COUNTRY = 'England' GROUP BY ALL""",
    "filter_complete_months": f"""
SELECT {_day('CALENDAR_MONTH')} AS calendar_month, count(*) AS n_rows FROM eng_complete GROUP BY ALL""",
    "filter_gender": "SELECT GENDER, SEX, count(*) AS n_rows FROM to_gender WHERE GENDER <> 'Other' GROUP BY ALL",
    "filter_impossible_pairs": """
SELECT GENDER, CANCERTYPE, count(*) AS n_rows FROM to_gender
WHERE GENDER <> 'Other' AND NOT (GENDER = 'Female' AND CANCERTYPE = 'PROSTATE')
 AND NOT (GENDER = 'Male' AND CANCERTYPE = 'CERVIX')
GROUP BY ALL""",
    "join_prescriptions": """
SELECT e.attendid, e.radiotherapyepisodeid, count(*) AS n_prescriptions,
 CAST(max(p.rtprescribeddose) AS DOUBLE) AS max_dose, max(p.prescribedfractions) AS max_fractions
FROM at_episodes e JOIN at_prescriptions p ON e.attendid = p.attendid AND e.orgcodeprovider = p.orgcodeprovider
 AND e.radiotherapyepisodeid = p.radiotherapyepisodeid AND e.patientid = p.patientid
GROUP BY e.attendid, e.radiotherapyepisodeid, e.orgcodeprovider, e.patientid, e.treatmentstartdate,
 e.radiotherapyintent, e.radiotherapydiagnosisicd""",
    "semi_join_exposures": """
SELECT p.attendid, p.orgcodeprovider, p.radiotherapyepisodeid, p.patientid, p.prescriptionid
FROM at_prescriptions p WHERE EXISTS (
 SELECT 1 FROM at_exposures x WHERE p.orgcodeprovider = x.orgcodeprovider AND p.attendid = x.attendid
  AND p.radiotherapyepisodeid = x.radiotherapyepisodeid AND p.patientid = x.patientid
  AND p.prescriptionid = x.prescriptionid)""",
    "join_patient": f"""
SELECT attendid, patientid, {_day('birthdatebest')} AS birthdatebest, sex FROM ep_patient""",
    "join_address": """
SELECT p.patientid, count(a.addressid) AS n_addresses
FROM (SELECT DISTINCT patientid FROM at_episodes) p LEFT JOIN address a ON p.patientid = a.patientid
GROUP BY p.patientid""",
    "join_geography": f"""
SELECT addressid, patientid, {_day('dateofaddress')} AS dateofaddress, icb_hb, imd19_quintile_lsoas FROM geo""",
    "join_network": """
SELECT ORGCODEPROVIDER, COUNTRY, PROVIDER_NAME, RT_NETWORK_NAME, CANCER_ALLIANCE_OLD, CANCER_ALLIANCE_NEW,
 count(*) AS n_rows FROM extract GROUP BY ALL""",
    "join_working_days": f"""
SELECT {_day('MONTH_DATE')} AS calendar_month, WORKING_DAYS, count(RADIOTHERAPYEPISODEID) AS n_rows
FROM with_wd GROUP BY ALL""",
    "max_month": """
SELECT max(CALENDAR_MONTH) AS max_month, substr(max(CALENDAR_MONTH), 6, 2) || substr(max(CALENDAR_MONTH), 1, 4) AS file_tag
FROM extract""",
    "agg_england_year": "SELECT * FROM eng_unfolded_yr",
    "agg_england_month": "SELECT * FROM eng_unfolded_mo",
    "agg_alliance_year": "SELECT * FROM ca_yr",
    "agg_alliance_month": "SELECT * FROM ca_mo",
    "agg_icb_year": "SELECT * FROM icb_yr",
    "agg_icb_month": "SELECT * FROM icb_mo",
    "low_count_fold": "SELECT * FROM eng_yr UNION ALL SELECT * FROM eng_mo",
    "distinct_core": "SELECT DISTINCT * EXCLUDE (W5_COUNT) FROM labelled",
    "first_known_demographics": """
SELECT DISTINCT radiotherapyepisodeid, raw_provider AS orgcodeprovider, chunk_id, ethnicity, ethnicityname, sex FROM core""",
    "episode_max_dose": """
SELECT DISTINCT radiotherapyepisodeid, raw_provider AS orgcodeprovider, chunk_id, CAST(max_dose AS DOUBLE) AS max_dose,
 max_fractions FROM core""",
    "episode_min_intent": """
SELECT DISTINCT radiotherapyepisodeid, orgcodeprovider AS mapped_provider, chunk_id,
 min(ordered_intent) OVER (PARTITION BY radiotherapyepisodeid, orgcodeprovider, chunk_id) AS min_intent
FROM core WHERE tx_age >= 18""",
    "episode_month_count": """
SELECT DISTINCT RADIOTHERAPYEPISODEID, CANCERTYPE, ORGCODEPROVIDER, CALENDAR_MONTH, W5_COUNT AS "COUNT" FROM labelled""",
    "episode_month_recount": """
SELECT DISTINCT RADIOTHERAPYEPISODEID, PROVIDER_NAME, CANCERTYPE, CALENDAR_MONTH, "COUNT" FROM extract""",
    "chunked_equals_single": "SELECT * FROM extract",
    "extract_from_raw_tables": "SELECT * FROM extract",
    "extract_file_roundtrip": "SELECT * FROM extract",
    "published_file_roundtrip": "SELECT * FROM published",
    "qa_value_profile": None,  # filled below
    "qa_unmatched_months": f"""
SELECT DISTINCT {_day('MONTH_DATE')} AS calendar_month, WORKING_DAYS AS working_days FROM with_wd WHERE EPI_YEAR IS NULL""",
    "qa_low_counts": "SELECT * FROM published WHERE episodeCount < 5",
    "qa_published_profile": "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM published GROUP BY ALL"
        for c in ("prim_val", "prim_lvl", "wd")),
    "qa_unknown_deprivation": "SELECT * FROM published WHERE prim_lvl = 'Deprivation' AND prim_val = 'Unknown'",
    "qa_level_slice": "SELECT * FROM published WHERE prim_lvl IN ('Deprivation', 'Treatment intent')",
}

_ATTRS = ("CANCERTYPE, AGEGROUP, ETHNICITY, GENDER, DEPRIVATION, INTENT, DOSE_FRACTIONATION_SCHEDULES, FRACTIONATION_CATEGORY, "
          "CANCER_ALLIANCE_NEW, ICB")
_NUMBER = "CAST(substr(RADIOTHERAPYEPISODEID, 2) AS BIGINT) % 97"
_MONTH_START = "CAST(strptime(CALENDAR_MONTH || '/01', '%Y/%m/%d') AS DATE)"
_LOOKUPS = {"at_patient": "patientid", "nspl": "pcd", "hlthau": "hlthaucd", "lsoa_icb": "lsoa11cd", "imd": "lsoa11_code",
            "rt_networks": "provider_code", "working_days": "calendar_month", "trustsics": "code"}
# The yearly chunks of the period, by hand.
_CHUNK_BOUNDS = [("2019-01-01", "2019-12-31"), ("2020-01-01", "2020-12-31"), ("2021-01-01", "2021-12-31"), ("2022-01-01", "2022-12-31"),
                 ("2023-01-01", "2024-05-31")]

FINAL |= {
    "single_valued_cells": f"""
SELECT EPI_YEAR, {_ATTRS}, count(*) AS n FROM (
 SELECT RADIOTHERAPYEPISODEID, EPI_YEAR, {_ATTRS}, count(*) OVER (PARTITION BY RADIOTHERAPYEPISODEID, EPI_YEAR) AS combinations
 FROM (SELECT DISTINCT RADIOTHERAPYEPISODEID, EPI_YEAR, {_ATTRS} FROM cleaned))
WHERE combinations = 1 GROUP BY ALL""",
    "resumed_extract": "SELECT * FROM extract",
    "incremental_refresh": "SELECT * FROM published",
    "published_by_manifest": "SELECT * FROM published",
    "qa_run_checks": "\nUNION ALL\n".join(
        [f"SELECT '{t}' AS step, 'repeated {k}' AS \"check\", count({k}) - count(DISTINCT {k}) AS value, "
         f"CAST(count({k}) = count(DISTINCT {k}) AS INTEGER) AS passed FROM {t}" for t, k in _LOOKUPS.items()]
        + ["SELECT 'extract_rows', 'rows', count(*), CAST(count(*) >= 1 AS INTEGER) FROM extract"]
        + [f"SELECT 'extract_rows', 'null {c}', count(*) - count({c}), CAST(count(*) = count({c}) AS INTEGER) FROM extract"
           for c in ("RADIOTHERAPYEPISODEID", "CALENDAR_MONTH")]
        + [f"SELECT 'extract_rows', 'rows of chunk {k}', count(*), CAST(count(*) >= 1 AS INTEGER) FROM extract "
           f"WHERE {_MONTH_START} BETWEEN DATE '{a}' AND DATE '{b}'" for k, (a, b) in enumerate(_CHUNK_BOUNDS, 1)]),
    "reject_report": f"""
SELECT * FROM (
 SELECT 'number of fields' AS reason, 19 AS n_fields, count(*) AS n_lines FROM extract WHERE {_NUMBER} = 0
 UNION ALL SELECT 'type of a field', 21, count(*) FROM extract WHERE {_NUMBER} = 1)
WHERE n_lines > 0""",
    "accepted_lines": f"SELECT * FROM extract WHERE {_NUMBER} NOT IN (0, 1)",
    "schedule_by_rules": f"""
SELECT DISTINCT cancertype, min_intent, CAST(max_dose AS DOUBLE) AS max_dose, max_fractions,
 {_schedule_case()} AS dose_fractionation_schedules, {_schedule_group_case()} AS schedule_group FROM rank1""",
    "stored_layout_join": f"""
SELECT e.attendid, e.radiotherapyepisodeid, p.prescriptionid, {_day('e.treatmentstartdate')} AS treatmentstartdate
FROM at_episodes e JOIN at_prescriptions p ON e.attendid = p.attendid AND e.orgcodeprovider = p.orgcodeprovider
 AND e.radiotherapyepisodeid = p.radiotherapyepisodeid AND e.patientid = p.patientid
WHERE e.treatmentstartdate BETWEEN DATE '{P0}' AND DATE '{P1}' AND EXISTS (
 SELECT 1 FROM at_exposures x WHERE p.orgcodeprovider = x.orgcodeprovider AND p.attendid = x.attendid
  AND p.radiotherapyepisodeid = x.radiotherapyepisodeid AND p.patientid = x.patientid AND p.prescriptionid = x.prescriptionid
  AND (p.rttreatmentmodality = '05' OR x.machineid IN ({_in(fv.ADMITTED_MACHINES)})))""",
}

_PROFILED = ["EPI_YEAR", "EPI_MONTH", "CALENDAR_MONTH", "INTENT", "AGEGROUP", "GENDER", "ETHNICITY",
             "DEPRIVATION", "ICB", "CANCERTYPE", "FRACTIONATION_CATEGORY", "DOSE_FRACTIONATION_SCHEDULES",
             "CANCER_ALLIANCE_NEW", "WORKING_DAYS", "SEX", "ETHNICITYNAME", "IMD19_QUINTILE_LSOAS", "ICB_HB"]


def _profile_value(c: str) -> str:
    if c == "CALENDAR_MONTH":
        return _day(c)
    return f"CAST({c} AS VARCHAR)"


FINAL["qa_value_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, {_profile_value(c)} AS value, count(*) AS n_rows FROM cleaned GROUP BY ALL"
    for c in _PROFILED)


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in FINAL.items()}
