"""The registered queries as standard SQL over the same parquet tables.

Written independently of the DataFrame plans, as the check they are compared
against: plain joins, plain windows, no salting, no pre-aggregation.
"""

from __future__ import annotations

from carelattice.plans.checks import ALL_CHECKS, RELATIONSHIPS

# Named subqueries: name -> (what it reads, SQL).
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_patient": ((), """
        SELECT CAST(c_custkey AS VARCHAR) AS patient_id, c_name AS first_name,
          'Family' || c_custkey AS last_name,
          CASE WHEN c_custkey % 3 = 0 THEN 'male' WHEN c_custkey % 3 = 1 THEN ' female ' ELSE 'unknown' END AS gender,
          CAST(DATE '1930-01-01' + CAST((c_custkey * 97) % 30000 AS INTEGER) AS VARCHAR) AS birth_date,
          c_mktsegment AS race, n_name AS ethnicity, '"' || n_name || ', X"' AS birth_place,
          n_name AS city, 'S' || n_regionkey AS state, 'Z' || (c_custkey % 1000) AS postal_code,
          'US' AS country,
          CASE WHEN c_custkey % 4 = 0 THEN 'M' WHEN c_custkey % 4 = 1 THEN 'S' END AS marital_status,
          'English ' AS language
        FROM customer JOIN nation ON c_nationkey = n_nationkey"""),
    "raw_encounter": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS encounter_id, CAST(o_custkey AS VARCHAR) AS patient_id,
          o_orderstatus AS status,
          CASE o_orderkey % 5 WHEN 0 THEN 'AMB' WHEN 1 THEN 'IMP' WHEN 2 THEN 'EMER' WHEN 3 THEN 'VR' ELSE 'ZZ' END AS class_code,
          o_orderpriority AS encounter_type, CAST(o_orderdate AS VARCHAR) AS start_date,
          CAST(o_orderdate + to_minutes((o_orderkey * 37) % 2880) AS VARCHAR) AS end_date,
          ' "Clinic ' || (o_custkey % 7) || '"' AS provider_name,
          CASE WHEN o_orderkey % 11 = 0 THEN 'Dr_x' ELSE 'Dr. A' || (o_custkey % 9) END AS practitioner
        FROM orders"""),
    "raw_claim": ((), """
        SELECT 'C' || o_orderkey AS claim_id, CAST(o_custkey AS VARCHAR) AS patient_id,
          CAST(o_orderkey AS VARCHAR) AS encounter_id, o_orderstatus AS status,
          'professional' AS claim_type, CAST(o_orderdate AS VARCHAR) AS created_date,
          'Clinic ' || (o_custkey % 7) AS provider_name, '"' || o_orderpriority || '" ' AS payer,
          CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS total_amount,
          ' USD' AS currency, 'SV' || (o_orderkey % 50) AS service_code,
          CASE WHEN o_orderkey % 2 = 0 THEN 'General exam (adult)' ELSE 'Exam #2' END AS service_desc
        FROM orders"""),
    "raw_condition": ((), """
        SELECT l_orderkey || '-' || l_linenumber AS condition_id, CAST(o_custkey AS VARCHAR) AS patient_id,
          CAST(l_orderkey AS VARCHAR) AS encounter_id, l_linestatus AS clinical_status,
          p_brand AS condition_code, 'http://snomed.info/sct' AS condition_system,
          p_type AS condition_name, CAST(l_shipdate AS VARCHAR) AS onset_date,
          CAST(l_shipdate AS VARCHAR) AS recorded_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "raw_procedure": ((), """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_suppkey AS procedure_id,
          CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_orderkey AS VARCHAR) AS encounter_id,
          l_linestatus AS status, CAST(l_suppkey AS VARCHAR) AS procedure_code,
          '"http://snomed.info/sct"' AS procedure_system, s_name AS procedure_name,
          CAST(l_shipdate AS VARCHAR) AS performed_start,
          CAST(l_shipdate + to_minutes(CAST(l_quantity AS INTEGER)) AS VARCHAR) AS performed_end
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey"""),
    "raw_medication_request": ((), """
        SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey AS medication_id,
          CAST(o_custkey AS VARCHAR) AS patient_id, CAST(l_orderkey AS VARCHAR) AS encounter_id,
          l_linestatus AS status, 'order' AS intent, p_brand AS medication_code,
          p_name AS medication_name, CAST(l_shipdate AS VARCHAR) AS authored_date,
          'Dr. A' || (o_custkey % 9) AS requester
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""),
    "raw_observation": ((), """
        SELECT CAST(event_id AS VARCHAR) AS observation_id, CAST(user_id AS VARCHAR) AS patient_id,
          CAST(user_id AS VARCHAR) AS encounter_id, 'final' AS status,
          ' ' || user_id || '-' || (event_id % 10) AS obs_code, 'http://loinc.org' AS obs_system,
          props AS obs_name, CAST(ts AS VARCHAR) AS effective_date,
          CASE WHEN event_id % 7 = 0 THEN '-' ELSE '' END || CAST(value AS VARCHAR) AS value,
          CASE WHEN event_id % 5 = 0 THEN 'mm[Hg]' ELSE event_type END AS unit
        FROM events"""),
    "claim": (("raw_claim",), """
        SELECT trim(claim_id) AS claim_id, trim(patient_id) AS patient_id, trim(encounter_id) AS encounter_id,
          trim(status) AS status, trim(claim_type) AS claim_type,
          replace(trim(provider_name), '"', '') AS provider_name, replace(trim(payer), '"', '') AS payer,
          TRY_CAST(replace(trim(created_date), '"', '') AS TIMESTAMP) AS created_date,
          TRY_CAST(total_amount AS DOUBLE) AS total_amount, trim(currency) AS currency,
          trim(service_code) AS service_code,
          CASE WHEN regexp_full_match(service_desc, '[a-zA-Z()/'' ]+') THEN trim(service_desc) END AS service_desc
        FROM raw_claim"""),
    "condition": (("raw_condition",), """
        SELECT trim(condition_id) AS condition_id, trim(patient_id) AS patient_id,
          trim(encounter_id) AS encounter_id, trim(clinical_status) AS clinical_status,
          trim(condition_code) AS condition_code, trim(condition_system) AS condition_system,
          trim(condition_name) AS condition_name, TRY_CAST(trim(onset_date) AS TIMESTAMP) AS onset_date,
          TRY_CAST(trim(recorded_date) AS TIMESTAMP) AS recorded_date
        FROM raw_condition"""),
    "encounter": (("raw_encounter",), """
        SELECT trim(encounter_id) AS encounter_id, trim(patient_id) AS patient_id, trim(status) AS status,
          trim(class_code) AS class_code, trim(encounter_type) AS encounter_type,
          TRY_CAST(trim(start_date) AS TIMESTAMP) AS start_date, TRY_CAST(trim(end_date) AS TIMESTAMP) AS end_date,
          replace(trim(provider_name), '"', '') AS provider_name,
          CASE WHEN regexp_full_match(practitioner, '(DR\\.|Dr\\.)?[a-zA-Z0-9()/'' ]+') THEN trim(practitioner) END AS practitioner
        FROM raw_encounter"""),
    "medication_request": (("raw_medication_request",), """
        SELECT trim(medication_id) AS medication_id, trim(patient_id) AS patient_id,
          trim(encounter_id) AS encounter_id, trim(status) AS status, trim(medication_code) AS medication_code,
          replace(trim(medication_name), '"', '') AS medication_name,
          TRY_CAST(trim(authored_date) AS TIMESTAMP) AS authored_date,
          CASE WHEN regexp_full_match(requester, '(DR\\.|Dr\\.)?[a-zA-Z0-9()/'' ]+') THEN trim(requester) END AS requester
        FROM raw_medication_request"""),
    "observation": (("raw_observation",), """
        SELECT trim(observation_id) AS observation_id, trim(patient_id) AS patient_id,
          trim(encounter_id) AS encounter_id, trim(status) AS status,
          CASE WHEN regexp_full_match(trim(obs_code), '[0-9]+-[0-9]+') THEN trim(obs_code) END AS obs_code,
          trim(obs_system) AS obs_system, replace(trim(obs_name), '"', '') AS obs_name,
          TRY_CAST(replace(trim(effective_date), '"', '') AS TIMESTAMP) AS effective_date,
          CASE WHEN regexp_full_match(trim(value), '[0-9]+(\\.[0-9]+)?') THEN TRY_CAST(value AS DOUBLE) END AS value,
          CASE WHEN regexp_full_match(trim(unit), '[a-zA-Z%/{]+') THEN trim(unit) END AS unit
        FROM raw_observation"""),
    "patient": (("raw_patient",), """
        SELECT trim(patient_id) AS patient_id, trim(regexp_replace(first_name, '[0-9]+$', '')) AS first_name,
          trim(regexp_replace(last_name, '[0-9]+$', '')) AS last_name, trim(gender) AS gender,
          TRY_CAST(trim(birth_date) AS TIMESTAMP) AS birth_date,
          CAST(2024 - year(TRY_CAST(trim(birth_date) AS TIMESTAMP)) AS INTEGER) AS age,
          trim(race) AS race, trim(ethnicity) AS ethnicity, replace(trim(birth_place), '"', '') AS birth_place,
          trim(city) AS city, trim(state) AS state, trim(postal_code) AS postal_code,
          trim(marital_status) AS marital_status, trim(language) AS language
        FROM raw_patient"""),
    "procedure": (("raw_procedure",), """
        SELECT trim(procedure_id) AS procedure_id, trim(patient_id) AS patient_id,
          trim(encounter_id) AS encounter_id, trim(status) AS status, trim(procedure_code) AS procedure_code,
          replace(trim(procedure_system), '"', '') AS procedure_system,
          replace(trim(procedure_name), '"', '') AS procedure_name,
          TRY_CAST(performed_start AS TIMESTAMP) AS performed_start,
          TRY_CAST(performed_end AS TIMESTAMP) AS performed_end
        FROM raw_procedure"""),
    "condition_patient": (("condition", "patient"), """
        SELECT c.*, p.first_name, p.last_name, p.gender, p.age, p.race, p.ethnicity, p.birth_date
        FROM condition c LEFT JOIN patient p ON c.patient_id = p.patient_id"""),
    "encounter_claim": (("encounter", "claim", "procedure"), """
        SELECT e.*, c.claim_id, c.status AS claim_status, c.claim_type, c.payer, c.total_amount,
          c.service_code, c.service_desc, c.created_date, p.procedure_code, p.procedure_name,
          p.procedure_system, p.performed_start, p.performed_end
        FROM encounter e LEFT JOIN claim c ON e.encounter_id = c.encounter_id
          LEFT JOIN procedure p ON e.encounter_id = p.encounter_id"""),
    "encounter_condition": (("encounter", "condition"), """
        SELECT e.*, c.condition_code, c.condition_name, c.condition_system, c.clinical_status,
          c.onset_date, c.recorded_date
        FROM encounter e LEFT JOIN condition c
          ON e.encounter_id = c.encounter_id AND e.patient_id = c.patient_id"""),
    "encounter_patient": (("encounter", "patient"), """
        SELECT e.*, p.first_name, p.last_name, p.gender, p.age, p.race, p.ethnicity, p.birth_date,
          p.city, p.postal_code, p.marital_status
        FROM encounter e LEFT JOIN patient p ON e.patient_id = p.patient_id"""),
    "medication_condition": (("medication_request", "condition"), """
        SELECT m.*, c.condition_code, c.condition_name, c.condition_system, c.clinical_status
        FROM medication_request m LEFT JOIN condition c
          ON m.encounter_id = c.encounter_id AND m.patient_id = c.patient_id"""),
    "demographics": (("patient",), """
        SELECT patient_id, gender, race,
          CASE WHEN age < 18 THEN '0-17' WHEN age < 35 THEN '18-34' WHEN age < 55 THEN '35-54'
               WHEN age < 75 THEN '55-74' ELSE '75+' END AS age_group
        FROM patient"""),
    "diagnosed": (("condition", "demographics"), """
        SELECT c.condition_name, c.patient_id, d.age_group, d.gender, d.race
        FROM condition c LEFT JOIN demographics d ON c.patient_id = d.patient_id"""),
    "stays": (("encounter_condition",), """
        SELECT encounter_type, condition_name, date_diff('minute', start_date, end_date) AS stay
        FROM encounter_condition"""),
    "early_claims": (("claim",), """
        SELECT * FROM claim WHERE created_date <= TIMESTAMP '1999-12-31 00:00:00'"""),
    "late_claims": (("claim",), """
        SELECT * REPLACE (total_amount + 1 AS total_amount)
        FROM claim WHERE created_date >= TIMESTAMP '1999-06-01 00:00:00'"""),
}


def sql(query: str, *reads: str, over: dict[str, str] | None = None) -> str:
    """``query`` behind the named subqueries it reads.

    ``over`` puts another subquery in the place of a named one, which it can read
    as ``all_<name>``.
    """
    over = over or {}
    needed: list[str] = []

    def add(name: str) -> None:
        for dependency in _VIEWS[name][0]:
            add(dependency)
        if name not in needed:
            needed.append(name)

    for name in reads:
        add(name)
    if not needed:
        return query.strip()
    views = [
        f"all_{n} AS ({_VIEWS[n][1]}),\n{n} AS ({over[n]})" if n in over else f"{n} AS ({_VIEWS[n][1]})"
        for n in needed
    ]
    return "WITH " + ",\n".join(views) + f"\n{query.strip()}"


def rows_of(name: str) -> str:
    return sql(f"SELECT * FROM {name}", name)


_VISIT = "patient_id, encounter_id, encounter_type, start_date"

READMISSIONS = sql(f"""
    SELECT {_VISIT}, date_diff('day', previous, start_date) AS days_since_last_visit
    FROM (SELECT *, lag(start_date) OVER (PARTITION BY patient_id ORDER BY start_date NULLS LAST, encounter_id) AS previous
          FROM encounter)
    WHERE previous IS NOT NULL AND date_diff('day', previous, start_date) < 30
""", "encounter")

READMISSIONS_INPATIENT = sql(f"""
    SELECT {_VISIT}, date_diff('day', previous, start_date) AS days_since_last_visit
    FROM (SELECT *, lag(start_date) OVER (PARTITION BY patient_id ORDER BY start_date NULLS LAST, encounter_id) AS previous
          FROM encounter WHERE class_code = 'IMP')
    WHERE previous IS NOT NULL AND date_diff('day', previous, start_date) <= 30
""", "encounter")

READMISSIONS_PER_BILLED_ROW = sql(f"""
    SELECT {_VISIT}, date_diff('day', previous, start_date) AS days_since_last_visit
    FROM (SELECT *, lag(start_date) OVER (PARTITION BY patient_id ORDER BY start_date NULLS LAST, encounter_id) AS previous
          FROM encounter_claim)
    WHERE previous IS NOT NULL AND date_diff('day', previous, start_date) < 30
""", "encounter_claim")

READMISSION_FLAG = sql(f"""
    SELECT {_VISIT}, coalesce(date_diff('day', lag(start_date) OVER (
        PARTITION BY patient_id ORDER BY start_date NULLS LAST, encounter_id), start_date) <= 30, FALSE) AS is_readmission
    FROM encounter
""", "encounter")


def prevalence(total: str, scale: int, rate: str, over: dict[str, str] | None = None) -> str:
    return sql(f"""
    , groups AS (SELECT age_group, gender, race, count(DISTINCT patient_id) AS total_group_patients
                 FROM {total} GROUP BY age_group, gender, race),
    sick AS (SELECT condition_name, age_group, gender, race, count(DISTINCT patient_id) AS patients_with_condition
             FROM diagnosed GROUP BY condition_name, age_group, gender, race)
    SELECT s.*, g.total_group_patients,
      round(CAST(patients_with_condition AS DOUBLE) / CAST(total_group_patients AS DOUBLE) * {scale}, 2) AS {rate}
    FROM sick s JOIN groups g ON s.age_group = g.age_group AND s.gender = g.gender AND s.race = g.race
    """, "diagnosed", "demographics", over=over)


def length_of_stay(mode_order: str, nulls: str, over: dict[str, str] | None = None) -> str:
    return sql(f"""
    , stats AS (SELECT encounter_type, condition_name, quantile_cont(stay, 0.5) AS median_stay,
        avg(stay) AS mean_stay, min(stay) AS min_stay, max(stay) AS max_stay,
        round(stddev_samp(stay), 2) AS stddev_stay
      FROM stays GROUP BY encounter_type, condition_name),
    modes AS (SELECT *, row_number() OVER (PARTITION BY encounter_type, condition_name
                ORDER BY n {mode_order}, stay {nulls}) AS rn
      FROM (SELECT encounter_type, condition_name, stay, count(*) AS n FROM stays GROUP BY ALL))
    SELECT s.*, m.stay AS mode_stay
    FROM stats s LEFT JOIN modes m
      ON s.encounter_type = m.encounter_type AND s.condition_name = m.condition_name AND m.rn = 1
    """, "stays", over=over)


PREVALENCE_KEYED = (
    "SELECT md5(condition_name || '-' || age_group || '-' || gender || '-' || race) AS surrogate_key, * FROM ("
    + prevalence("diagnosed", 100, "prevalence_percentage") + ")"
)

MEDICATION_PATTERNS = sql("""
    SELECT *, rank() OVER (PARTITION BY condition_name ORDER BY total_prescriptions DESC) AS rn
    FROM (SELECT medication_name, condition_name, count(DISTINCT patient_id) AS patients_count,
            count(*) AS total_prescriptions
          FROM medication_condition GROUP BY 1, 2)
""", "medication_condition")

MEDICATION_PATTERNS_TOP3 = f"SELECT * FROM ({MEDICATION_PATTERNS}) WHERE rn <= 3"

MEDICATION_PATTERNS_CROWDED = sql("""
    SELECT *, rank() OVER (PARTITION BY condition_name ORDER BY total_prescriptions DESC) AS rn
    FROM (SELECT medication_name, condition_name, count(DISTINCT patient_id) AS patients_count,
            count(*) AS total_prescriptions
          FROM medication_condition GROUP BY 1, 2)
""", "medication_condition", over={
    "medication_request": "SELECT * REPLACE (medication_name || '/' || CAST(split_part(medication_id, '-', 1) AS BIGINT) % 2000 AS medication_name) "
                          "FROM all_medication_request",
    "condition": "SELECT * REPLACE (CASE WHEN CAST(split_part(condition_id, '-', 1) AS BIGINT) % 3 = 0 THEN 'CROWD' "
                 "ELSE condition_name END AS condition_name) FROM all_condition"})

PREVALENCE_ESTIMATED = (
    "SELECT * EXCLUDE (prevalence_percentage), TRUE AS patients_with_condition_near, TRUE AS total_group_patients_near FROM ("
    + prevalence("diagnosed", 100, "prevalence_percentage") + ")")

INCREMENTAL_FILTER = sql("""
    SELECT * FROM late_claims
    WHERE created_date > (SELECT coalesce(max(created_date), TIMESTAMP '1900-01-01 00:00:00') FROM early_claims)
""", "early_claims", "late_claims")

INCREMENTAL_LOOKBACK = sql("""
    SELECT * FROM late_claims
    WHERE created_date > (SELECT coalesce(max(created_date), TIMESTAMP '1900-01-01 00:00:00') - INTERVAL 90 DAY FROM early_claims)
""", "early_claims", "late_claims")

INCREMENTAL_MERGE = sql("""
    SELECT * FROM early_claims WHERE claim_id NOT IN (SELECT claim_id FROM late_claims)
    UNION ALL SELECT * FROM late_claims
""", "early_claims", "late_claims")

INCREMENTAL_LOAD = sql("""
    SELECT * FROM early_claims
    UNION ALL SELECT * FROM late_claims WHERE created_date > (SELECT max(created_date) FROM early_claims)
""", "early_claims", "late_claims")

MERGE_DEDUP = sql("""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY recorded_date DESC NULLS LAST,
        patient_id DESC, condition_code DESC, condition_name DESC, clinical_status DESC) AS rn
      FROM condition)
    WHERE rn = 1
""", "condition")

FN = {
    "fn_surrogate_key": sql("""
        SELECT claim_id, md5(coalesce(claim_id, 'NULL') || '-' || coalesce(nullif(status, 'F'), 'NULL') || '-' || coalesce(service_desc, 'NULL')) AS claim_key
        FROM claim""", "claim"),
    "fn_age": sql("""
        SELECT patient_id, age AS age_by_calendar_year,
          CAST(floor(date_diff('day', birth_date, TIMESTAMP '2024-01-01') / 365.25) AS INTEGER) AS age_in_years
        FROM patient""", "patient"),
    "fn_age_bucket": sql("""
        SELECT patient_id, age_group,
          CASE WHEN nullif(age, 50) IS NULL THEN 'unknown' ELSE age_group END AS age_group_labelled
        FROM patient JOIN demographics USING (patient_id)""", "patient", "demographics"),
    "fn_safe_divide": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CASE WHEN l_tax = 0 THEN 0.0 ELSE l_extendedprice / l_tax END AS price_per_tax
        FROM lineitem""",
    "fn_nullif_zero": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_discount, 0) AS discount
        FROM lineitem""",
    "fn_days_between": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          date_diff('day', o_orderdate, l_shipdate) AS days_to_ship,
          date_diff('minute', o_orderdate, l_shipdate + to_minutes(CAST(l_quantity AS INTEGER))) AS minutes_to_ship
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fn_round": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice, 1) AS rounded
        FROM lineitem""",
}


def checks(checks_list, over: dict[str, str] | None = None) -> str:
    """One counting SELECT per check, glued together."""
    parts, reads = [], []
    for c in checks_list:
        reads.append(c.table)
        if c.kind == "not_null":
            failures = f"SELECT count(*) FROM {c.table} WHERE {c.column} IS NULL"
        elif c.kind == "unique":
            failures = (f"SELECT count(*) FROM (SELECT {c.column} FROM {c.table} WHERE {c.column} IS NOT NULL "
                        f"GROUP BY {c.column} HAVING count(*) > 1)")
        elif c.kind == "accepted_values":
            values = ", ".join(f"'{v}'" for v in c.values)
            failures = f"SELECT count(*) FROM {c.table} WHERE {c.column} NOT IN ({values})"
        else:
            reads.append(c.parent)
            failures = (f"SELECT count(*) FROM {c.table} k WHERE {c.column} IS NOT NULL AND NOT EXISTS "
                        f"(SELECT 1 FROM {c.parent} p WHERE p.{c.parent_column} = k.{c.column})")
        parts.append(f"SELECT '{c.table}' AS table_name, '{c.column}' AS column_name, '{c.kind}' AS check_name, "
                     f"'{c.severity}' AS severity, ({failures}) AS failures")
    return sql(f"SELECT *, failures = 0 AS passed FROM ({' UNION ALL '.join(parts)})", *dict.fromkeys(reads),
               over=over)


def _flattened(name: str) -> str:
    """What the flattener returns for a rendered bundle: the raw row, blanks as NULL."""
    replaced = {
        "patient": "replace(birth_place, '\"', '') AS birth_place",
        "claim": "nullif(total_amount, 'n/a') AS total_amount",
    }.get(name)
    star = f"* REPLACE ({replaced})" if replaced else "*"
    return sql(f"SELECT {star} FROM raw_{name}", f"raw_{name}")


FHIR = {
    name: _flattened(name)
    for name in ("patient", "encounter", "claim", "condition", "procedure", "observation", "medication_request")
}

FHIR_QUARANTINE = "SELECT 'document/' || doc_id AS bundle_id, 'malformed bundle' AS reason FROM documents"

_TYPED = {
    "patient": ("patient_id", "NULL"), "encounter": ("encounter_id", "encounter_id"), "claim": ("claim_id", "encounter_id"),
    "condition": ("condition_id", "encounter_id"), "procedure": ("procedure_id", "encounter_id"),
    "observation": ("observation_id", "encounter_id"), "medication_request": ("medication_id", "encounter_id"),
}
_IDS_OF_ALL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {key} AS row_id, patient_id, {visit} AS encounter_id FROM raw_{t}"
    for t, (key, visit) in _TYPED.items())
# Bundles by patient: observations of people who are no customers come with a patient of their own.
FHIR_ALL = sql(_IDS_OF_ALL + """
    UNION ALL SELECT DISTINCT 'patient', patient_id, patient_id, NULL FROM raw_observation
    WHERE patient_id NOT IN (SELECT patient_id FROM raw_patient)
""", *[f"raw_{t}" for t in _TYPED])

# Four bundles; the last character of a row's key tells its own, whose first patient stands for all.
_FILE = "'bundle-' || (ascii(right({}, 1)) % 4)"
FHIR_LARGE = sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, {key} AS row_id, {'patient_id' if t == 'patient' else _FILE.format(key)} AS patient_id, "
    f"{visit} AS encounter_id FROM raw_{t}" for t, (key, visit) in _TYPED.items()) + """
    UNION ALL SELECT 'patient', 'bundle-' || k, 'bundle-' || k, NULL FROM range(4) AS files(k)
""", *[f"raw_{t}" for t in _TYPED])

FHIR_MISSHAPEN = """
    SELECT 'C' || o_orderkey AS bundle_id, 'Claim' AS resource_type, 'field of another shape' AS reason
    FROM orders WHERE o_orderkey % 13 = 0
"""

# Table, key, watermark and number of columns.
_REGISTERED = [
    ("patient", "patient_id", None, 14), ("encounter", "encounter_id", "start_date", 9),
    ("claim", "claim_id", "created_date", 12), ("condition", "condition_id", "recorded_date", 9),
    ("procedure", "procedure_id", "performed_start", 9), ("observation", "observation_id", "effective_date", 10),
    ("medication_request", "medication_id", "authored_date", 9),
]
REGISTRY = sql(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{key}' AS key, {repr(mark) if mark else 'NULL'} AS watermark, "
    f"CAST({n} AS INTEGER) AS n_columns, (SELECT count(*) FROM raw_{t}) AS n_rows" for t, key, mark, n in _REGISTERED
), *[f"raw_{t}" for t, *_ in _REGISTERED])

_RAISED = "CAST(TRY_CAST(total_amount AS DOUBLE) + 1 AS VARCHAR)"

LAND_ROUNDTRIP = sql(f"""
    SELECT *, '2024' AS year, '06' AS month, '07' AS day FROM raw_claim WHERE created_date <= '1999-12-31 00:00:00'
    UNION ALL
    SELECT * REPLACE ({_RAISED} AS total_amount), '2024', '06', '08' FROM raw_claim
    WHERE created_date >= '1999-06-01 00:00:00'
""", "raw_claim")

_CLAIM_NUMBER = "CAST(substr(claim_id, 2) AS BIGINT)"
LAND_MULTILINE = sql(f"""
    SELECT * REPLACE (
        CASE WHEN {_CLAIM_NUMBER} % 3 = 0
          THEN service_desc || chr(10) || '"line", 2' || chr(13) || chr(10) || chr(10) || claim_id ELSE service_desc END AS service_desc,
        CASE WHEN {_CLAIM_NUMBER} % 7 = 0 THEN 'a "' || status || '"' || chr(10) ELSE status END AS status),
      '2024' AS year, '06' AS month, '07' AS day
    FROM raw_claim""", "raw_claim")

STREAM_UPSERT = INCREMENTAL_MERGE

STREAM_UNIQUE = sql("SELECT observation_id, patient_id, effective_date, value FROM observation", "observation")

def _newest(table: str, key: str, *order: str) -> str:
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {by}) AS rn "
            f"FROM all_{table}) WHERE rn = 1")


# The merge keeps one row per key, the latest by watermark and then by the other columns.
MERGED = {
    "condition": _newest("condition", "condition_id", "recorded_date", "patient_id", "encounter_id", "clinical_status",
                         "condition_code", "condition_system", "condition_name", "onset_date"),
    "procedure": _newest("procedure", "procedure_id", "performed_start", "patient_id", "encounter_id", "status",
                         "procedure_code", "procedure_system", "procedure_name", "performed_end"),
    "medication_request": _newest("medication_request", "medication_id", "authored_date", "patient_id", "encounter_id",
                                  "status", "medication_code", "medication_name", "requester"),
}

_PATTERNS = """
    SELECT *, rank() OVER (PARTITION BY condition_name ORDER BY total_prescriptions DESC) AS rn
    FROM (SELECT medication_name, condition_name, count(DISTINCT patient_id) AS patients_count,
            count(*) AS total_prescriptions
          FROM medication_condition GROUP BY 1, 2)
"""
REFRESH_MEDICATION_PATTERNS = sql(_PATTERNS, "medication_condition", over=MERGED)
REFRESHED = {
    "readmissions": READMISSIONS,
    "prevalence": prevalence("diagnosed", 100, "prevalence_percentage", MERGED),
    "length_of_stay": length_of_stay("DESC", "ASC NULLS LAST", MERGED),
}
REFRESH_REPORT = checks(ALL_CHECKS + RELATIONSHIPS, MERGED)

PRESENTED = {
    name: f"SELECT *, row_number() OVER (ORDER BY {order}) AS place FROM ({query})"
    for name, query, order in [
        ("prevalence", prevalence("diagnosed", 100, "prevalence_percentage"),
         "patients_with_condition DESC NULLS FIRST, condition_name NULLS LAST, age_group, gender, race"),
        ("length_of_stay", length_of_stay("DESC", "ASC NULLS LAST"),
         "mean_stay DESC NULLS FIRST, encounter_type NULLS LAST, condition_name NULLS LAST"),
        ("medication_patterns", MEDICATION_PATTERNS,
         "rn, condition_name NULLS LAST, medication_name NULLS LAST"),
    ]
}


def _renumbered(table: str, number: str, cases: str, *columns: str) -> str:
    replaced = ", ".join(f"CASE {cases.replace('n %', f'{number} %')} ELSE {c} END AS {c}" for c in columns)
    return f"SELECT * REPLACE ({replaced}) FROM all_{table}"


def _first_number(key: str) -> str:
    return f"CAST(split_part({key}, '-', 1) AS BIGINT)"


ENCOUNTER_CLAIM_SKEWED = sql("SELECT * FROM encounter_claim", "encounter_claim", over={
    "claim": _renumbered("claim", "CAST(substr(claim_id, 2) AS BIGINT)",
                         "WHEN n % 3 = 0 THEN '1' WHEN n % 100 = 7 THEN '7'", "encounter_id"),
    "procedure": _renumbered("procedure", _first_number("procedure_id"), "WHEN n % 40 = 7 THEN '7'", "encounter_id"),
})
MEDICATION_CONDITION_SKEWED = sql("SELECT * FROM medication_condition", "medication_condition", over={
    "medication_request": _renumbered("medication_request", _first_number("medication_id"),
                                      "WHEN n % 3 = 0 THEN '1' WHEN n % 60 = 7 THEN '7'", "encounter_id", "patient_id"),
    "condition": _renumbered("condition", _first_number("condition_id"),
                             "WHEN n % 5000 = 1 THEN '1' WHEN n % 300 = 7 THEN '7'", "encounter_id", "patient_id"),
})
READMISSIONS_SKEWED = sql(f"""
    SELECT {_VISIT}, date_diff('day', previous, start_date) AS days_since_last_visit
    FROM (SELECT *, lag(start_date) OVER (PARTITION BY patient_id ORDER BY start_date NULLS LAST, encounter_id) AS previous
          FROM encounter)
    WHERE previous IS NOT NULL AND date_diff('day', previous, start_date) < 30
""", "encounter", over={
    "encounter": _renumbered("encounter", "CAST(encounter_id AS BIGINT)", "WHEN n % 3 = 0 THEN '1'", "patient_id")})
