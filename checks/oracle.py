"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from checks import roles


def _quote(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _case(key: str, values: dict[str, str]) -> str:
    branches = " ".join(f"WHEN {_quote(k)} THEN {_quote(v)}" for k, v in values.items())
    return f"CASE {key} {branches} END"


MODE = _case("c_mktsegment", roles.MODES)
VERSION_MODE = _case("o_orderpriority", roles.VERSION_MODES)
ACTIVITY_TYPE = _case("o_orderpriority", roles.ACTIVITY_TYPES)
DECLARED = _case("c_mktsegment", roles.SEGMENT_PRACTICE)
PLACES = "[" + ", ".join(_quote(p) for p in roles.PLACES) + "]"


def home(nation: str, number: str) -> str:
    # The concatenation operator gives null for a missing place, as in the query.
    return f"(CAST({number} AS VARCHAR) || ' Rue du Port, ' || {PLACES}[{nation} + 1])"


def key_of(mode: str) -> str:
    lower = f"translate(lower(trim({mode})), 'éèêàâîôûç', 'eeeaaiouc')"
    return f"regexp_replace({lower}, '[/ ]', '_', 'g')"


def is_eco(mode: str) -> str:
    return f"coalesce({key_of(mode)} IN ('marche_running', 'velo_trottinette_autres'), false)"


def bonus(salary: str) -> str:
    return f"CAST(round({salary} * CAST(0.05 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2))"


def eco_bonus(salary: str, mode: str) -> str:
    return f"CASE WHEN {is_eco(mode)} THEN {bonus(salary)} ELSE CAST(0 AS DECIMAL(18,2)) END"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


EMPLOYEES = f"""
employees AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id_salarie, c_name AS nom,
           'P' || CAST(c_nationkey AS VARCHAR) AS prenom,
           CAST(c_acctbal AS VARCHAR) AS salaire_brut,
           CAST(c_acctbal AS DECIMAL(18,2)) AS salaire,
           {MODE} AS moyen_deplacement,
           {home('c_nationkey', 'c_custkey % 50')} AS adresse
    FROM customer
),
priced AS (
    SELECT *, {eco_bonus('salaire', 'moyen_deplacement')} AS prime_annuelle FROM employees
)"""

VERSIONS = f"""
versions AS (
    SELECT CAST(o_custkey AS VARCHAR) AS id_salarie, CAST(o_totalprice AS VARCHAR) AS salaire_brut,
           CAST(o_totalprice AS DECIMAL(18,2)) AS salaire,
           {VERSION_MODE} AS moyen_deplacement,
           o_orderdate AS version_date, o_orderkey AS version_no,
           {eco_bonus('CAST(o_totalprice AS DECIMAL(18,2))', VERSION_MODE)} AS prime_annuelle
    FROM orders
),
latest AS (
    SELECT * FROM versions
    QUALIFY row_number() OVER (
        PARTITION BY id_salarie ORDER BY version_date DESC, version_no DESC) = 1
)"""

ACTIVITIES = f"""
activities AS (
    SELECT CAST(o_custkey AS VARCHAR) AS id_salarie, o_orderdate AS start_date,
           {ACTIVITY_TYPE} AS activity_type, o_totalprice AS distance_m, o_orderkey AS activity_no
    FROM orders
)"""

TOTALS = f"""
declared_counts AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id_salarie,
           count(*) FILTER (WHERE trim({DECLARED}) <> '') AS n
    FROM customer GROUP BY 1
),
recorded_counts AS (
    SELECT CAST(o_custkey AS VARCHAR) AS id_salarie, count(*) AS n FROM orders GROUP BY 1
),
totals AS (
    SELECT coalesce(d.id_salarie, r.id_salarie) AS id_salarie,
           {big('coalesce(d.n, 0)')} AS nb_activites_excel,
           {big('coalesce(r.n, 0)')} AS nb_activites_delta,
           {big('coalesce(d.n, 0) + coalesce(r.n, 0)')} AS nb_activites_total
    FROM declared_counts d FULL OUTER JOIN recorded_counts r ON d.id_salarie = r.id_salarie
)"""

TOTALS_ELSEWHERE = f"""
WITH d AS (
    SELECT CAST(doc_id AS VARCHAR) AS id, count(*) FILTER (WHERE quality = 1) AS n
    FROM labels GROUP BY 1
),
r AS (SELECT CAST(user_id AS VARCHAR) AS id, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(d.id, r.id) AS id_salarie,
       {big('coalesce(d.n, 0)')} AS nb_activites_excel,
       {big('coalesce(r.n, 0)')} AS nb_activites_delta,
       {big('coalesce(d.n, 0) + coalesce(r.n, 0)')} AS nb_activites_total
FROM d FULL OUTER JOIN r ON d.id = r.id"""

INCOMPLETE = f"""
incomplete AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id_salarie,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(c_acctbal AS VARCHAR) END AS salaire_brut,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN {MODE} END AS moyen_deplacement,
           CASE WHEN c_nationkey > 3 THEN c_name END AS nom,
           CASE WHEN c_acctbal > 0 THEN 'P' || CAST(c_nationkey AS VARCHAR) END AS prenom,
           c_nationkey + 18352 AS date_embauche,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 'CDD' END AS type_contrat,
           'BU' || CAST(c_nationkey AS VARCHAR) AS bu,
           c_acctbal
    FROM customer
),
filled AS (
    SELECT id_salarie, coalesce(salaire_brut, '30000') AS salaire_brut,
           coalesce(moyen_deplacement, 'Non spécifié') AS moyen_deplacement,
           coalesce(nom, 'Inconnu') AS nom, coalesce(prenom, 'Inconnu') AS prenom,
           date_embauche, coalesce(type_contrat, 'CDI') AS type_contrat,
           coalesce(bu, 'Non spécifié') AS bu,
           salaire_brut IS NULL AS salary_defaulted,
           coalesce(CAST(CASE WHEN salaire_brut IS NOT NULL THEN c_acctbal END AS DECIMAL(18,2)),
                    30000) AS salaire
    FROM incomplete
),
filled_priced AS (
    SELECT *, {eco_bonus('CAST(salaire AS DECIMAL(18,2))', 'moyen_deplacement')} AS prime_annuelle
    FROM filled
)"""


def bonus_stats(source: str) -> str:
    return f"""
SELECT moyen_deplacement, {big('count(*)')} AS nombre_employes,
       {dbl('CAST(round(avg(prime_annuelle), 2) AS DECIMAL(18,2))')} AS prime_moyenne,
       {dbl('sum(prime_annuelle)')} AS budget_total
FROM {source} GROUP BY moyen_deplacement"""


def title_case(text: str) -> str:
    # Title case turns a leading sharp s into two letters; `upper` keeps it.
    letter = r"\p{Lu}\p{Ll}\p{Lt}"
    first = "CASE w[1] WHEN 'ß' THEN 'Ss' ELSE upper(w[1]) END"
    runs = f"regexp_extract_all({text}, '[{letter}]+|[^{letter}]+')"
    return f"array_to_string(list_transform({runs}, lambda w: {first} || lower(w[2:])), '')"


def city_distance(address: str) -> str:
    bands = [
        ("montpellier", 5.5), ("lattes", 3), ("frontignan", 27.5),
        ("saint-clément-de-rivière", 10), ("nîmes", 47.5), ("pérols", 6.5), ("mèze", 32.5),
        ("prades-le-lez", 12.5), ("mauguio", 10), ("vendargues", 15),
        ("clermont-l-hérault", 42.5), ("grabels", 17.5),
    ]
    tests = " ".join(f"WHEN contains(lower({address}), {_quote(c)}) THEN {km}" for c, km in bands)
    return f"CAST(CASE {tests} END AS DOUBLE)"


def postcode_distance(address: str) -> str:
    bands = [
        ("34000", 6.5), ("34090", 6.5), ("34970", 3), ("34110", 27.5), ("30900", 47.5),
        ("34470", 6.5), ("34140", 32.5), ("34730", 12.5), ("34130", 10), ("34740", 15),
        ("34800", 42.5), ("34790", 17.5),
    ]
    tests = " ".join(f"WHEN contains({address}, {_quote(c)}) THEN {km}" for c, km in bands)
    return f"CAST(CASE {tests} END AS DOUBLE)"


def place_words(text: str) -> str:
    plain = f"translate(lower({text}), 'éèêàâîôûç', 'eeeaaiouc')"
    return f"regexp_extract_all({plain}, '[\\p{{L}}\\p{{N}}]+')"


def verdict(km: str, mode: str) -> str:
    def has(*words: str) -> str:
        return "(" + " OR ".join(f"contains(lower({mode}), {_quote(w)})" for w in words) + ")"

    def limit(value: int, label: str) -> str:
        return (
            f"CASE WHEN {km} <= {value} THEN 'Valide' "
            f"ELSE 'Erreur: ' || CAST({km} AS VARCHAR) || 'km > {value}km ({label})' END"
        )

    return f"""CASE WHEN {km} IS NULL OR {mode} IS NULL THEN 'Erreur: Données manquantes'
        WHEN {has('voiture', 'thermique', 'electrique', 'transport', 'commun')}
            THEN 'Mode exclu: Véhicule motorisé ou transport'
        WHEN {has('marche', 'running')} THEN {limit(15, 'Marche')}
        WHEN {has('vélo', 'velo', 'trottinette')} THEN {limit(25, 'Vélo')}
        ELSE 'Mode non spécifié' END"""


MEASURED = f"""
measured AS (
    SELECT {home('s_nationkey', 's_suppkey % 50')} AS place,
           min(abs(s_acctbal) * 10) / 1000 AS km
    FROM supplier GROUP BY 1
),
distances AS (
    SELECT e.*, coalesce(m.km, {city_distance('e.adresse')}, {postcode_distance('e.adresse')},
                         22.5) AS distance_km
    FROM employees e LEFT JOIN measured m ON trim(e.adresse) = trim(m.place)
)"""

BANDED = f"""
banded AS (
    SELECT *, coalesce({city_distance('adresse')}, {postcode_distance('adresse')}, 22.5)
              AS distance_km
    FROM employees
)"""

CDC_ACTIVITIES = """
SELECT CAST(user_id AS VARCHAR) AS id_salarie, ts AS start_date, event_type AS activity_type,
       value AS distance_m,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS duration_sec,
       CASE WHEN event_type <> 'error' THEN props END AS comment
FROM events"""

FAULTY = """
faulty AS (
    SELECT event_id, event_type,
           CASE event_type
               WHEN 'error' THEN '{"payload": ' || event_id
               WHEN 'signup' THEN '{"schema": ' || event_id || '}'
               WHEN 'click' THEN '{"payload": {"op": "u", "ts_ms": ' || event_id || '}}'
               WHEN 'purchase' THEN
                   '{"payload": {"op": "c", "after": {"'
                   || CASE event_id % 3 WHEN 0 THEN 'comment' ELSE 'id_salarie' END || '": "' || event_id
                   || CASE event_id % 3 WHEN 1 THEN '", "distance_m": "abc' ELSE '' END || '"}}}'
           END AS value
    FROM events
)"""

REJECTS = f"""WITH {FAULTY}
SELECT value AS raw_value,
       CASE event_type WHEN 'view' THEN 'empty message' WHEN 'error' THEN 'broken json'
            WHEN 'signup' THEN 'no payload' WHEN 'click' THEN 'no new image'
            ELSE CASE event_id % 3 WHEN 0 THEN 'no key' ELSE 'bad field: distance_m' END
       END AS reason
FROM faulty WHERE event_type <> 'purchase' OR event_id % 3 < 2"""

CHEVAL = _case("o_orderpriority", {**roles.VERSION_MODES, "4-NOT SPECIFIED": "Cheval"})


def describe(column: str, number: str) -> str:
    return f"""
SELECT '{column}' AS colonne, {big(f'count({column})')} AS nombre,
       {dbl(f'round(avg({number}), 4)')} AS moyenne,
       {dbl(f'round(stddev_samp({number}), 4)')} AS ecart_type,
       CAST(min({column}) AS VARCHAR) AS minimum, CAST(max({column}) AS VARCHAR) AS maximum
FROM priced"""


def kpi(name: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS kpi, {dbl(value)} AS valeur FROM {source}"


_NULLABLE = (
    "id_salarie", "salaire_brut", "moyen_deplacement", "nom", "prenom", "date_embauche",
    "type_contrat", "bu",
)

SQL: dict[str, str] = {
    "scan_table": f"""
SELECT {big('count(*)')} AS nombre, {big('sum(l_orderkey)')} AS l_orderkey,
       {big('sum(l_partkey)')} AS l_partkey, {big('sum(l_suppkey)')} AS l_suppkey,
       {big('sum(l_linenumber)')} AS l_linenumber, max(l_quantity) AS l_quantity,
       max(l_extendedprice) AS l_extendedprice, max(l_discount) AS l_discount, max(l_tax) AS l_tax,
       max(l_returnflag) AS l_returnflag, max(l_linestatus) AS l_linestatus,
       max(l_shipdate) AS l_shipdate
FROM lineitem""",
    "point_lookup": "SELECT * FROM orders WHERE o_custkey = 76",
    "ingest_tabular": f"""WITH {EMPLOYEES}
SELECT lpad(id_salarie, 8, '0') AS id_salarie, nom, prenom, '1996-06-30' AS date_embauche,
       salaire_brut, adresse, moyen_deplacement FROM employees""",
    "csv_roundtrip": "SELECT doc_id, lang, source, n_chars, text FROM documents",
    "schema_evolution": """
SELECT c_name AS nom, c_acctbal AS salaire, CAST(NULL AS VARCHAR) AS bu FROM customer
UNION ALL SELECT s_name, s_acctbal, CAST(s_nationkey AS VARCHAR) FROM supplier""",
    "export_primes": f"""WITH {VERSIONS}
SELECT id_salarie AS "ID_employee", moyen_deplacement,
       replace(CAST(prime_annuelle AS VARCHAR), '.', ',') AS prime_annuelle,
       replace(CAST(salaire AS VARCHAR), '.', ',') AS salaire_brut
FROM latest""",
    "export_activities": f"""WITH {ACTIVITIES}
SELECT id_salarie, activity_type,
       CAST(CAST(distance_m AS DECIMAL(18,2)) AS VARCHAR) AS distance_m, activity_no
FROM activities""",
    "external_table": f"""
SELECT o_orderstatus, {big('2 * count(*)')} AS nombre FROM orders GROUP BY 1""",
    "clean_practice": f"""WITH {ACTIVITIES}
SELECT id_salarie, activity_type, activity_no FROM activities
QUALIFY row_number() OVER (PARTITION BY id_salarie ORDER BY activity_no) = 1""",
    "employee_rows": """
SELECT CAST(s_suppkey AS VARCHAR) AS id_salarie, '30000' AS salaire_brut,
       'Non spécifié' AS moyen_deplacement, s_name AS nom, 'Inconnu' AS prenom,
       CAST(NULL AS VARCHAR) AS date_embauche, 'CDI' AS type_contrat, 'Non spécifié' AS bu
FROM supplier""",
    "discover_id": f"""
SELECT CAST(user_id AS VARCHAR) AS id_salarie, {big('count(*)')} AS nb_activites_delta
FROM events GROUP BY 1""",
    "ensure_bonus": f"""WITH {EMPLOYEES}
SELECT id_salarie, {dbl('prime_annuelle')} AS prime_annuelle FROM priced""",
    "eco_bonus": f"""WITH {EMPLOYEES}
SELECT id_salarie, moyen_deplacement, {dbl('prime_annuelle')} AS prime FROM priced""",
    "cdc_parse": CDC_ACTIVITIES,
    "cdc_time_decode": """
SELECT event_id, ts AS moment, CAST(CAST(ts AS DATE) AS VARCHAR) AS jour FROM events""",
    "cdc_rejects": REJECTS,
    "stream_rejects": REJECTS,
    "current_activities": """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS id_salarie,
       CASE WHEN event_id % 3 = 1 THEN 'corrected' ELSE event_type END AS activity_type
FROM events WHERE event_id % 5 <> 0""",
    "current_table": f"""WITH {VERSIONS}
SELECT id_salarie, salaire_brut, moyen_deplacement
FROM latest JOIN orders ON o_orderkey = version_no WHERE o_orderstatus <> 'P'""",
    "export_kept": f"""WITH {EMPLOYEES}
SELECT id_salarie AS "ID_employee", moyen_deplacement,
       replace(CAST(prime_annuelle AS VARCHAR), '.', ',') AS prime_annuelle,
       replace(CAST(salaire AS VARCHAR), '.', ',') AS salaire_brut
FROM priced""",
    "live_export": f"WITH {INCOMPLETE} {bonus_stats('filled_priced')}",
    "eco_filter": f"""WITH {EMPLOYEES}
SELECT id_salarie, moyen_deplacement FROM employees WHERE {is_eco('moyen_deplacement')}""",
    "fill_defaults": f"""WITH {INCOMPLETE}
SELECT id_salarie, salaire_brut, moyen_deplacement, nom, prenom, date_embauche, type_contrat, bu
FROM filled""",
    "null_profile": f"WITH {INCOMPLETE}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS colonne, {big(f'count(*) FILTER (WHERE {c} IS NULL)')} AS nb_nuls "
        "FROM incomplete"
        for c in _NULLABLE
    ),
    "clean_hr": f"""
SELECT CAST(o_custkey AS VARCHAR) AS id_salarie,
       {title_case("'l''' || lower(o_orderpriority)")} AS nom,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END
           AS date_embauche,
       CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS salaire_brut,
       o_orderkey AS ligne
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
    "declared_counts": f"""
SELECT CAST(c_custkey AS VARCHAR) AS id_salarie,
       {big(f"count(*) FILTER (WHERE trim({DECLARED}) <> '')")} AS nb_activites_excel
FROM customer GROUP BY 1""",
    "activity_counts": f"""
SELECT CAST(o_custkey AS VARCHAR) AS id_salarie, {big('count(*)')} AS nb_activites_delta
FROM orders GROUP BY 1""",
    "activity_totals": TOTALS_ELSEWHERE,
    "combine_counts": TOTALS_ELSEWHERE,
    "active_employees": f"WITH {TOTALS} SELECT * FROM totals WHERE nb_activites_total >= 15",
    "top_active": f"""WITH {TOTALS}
SELECT * FROM totals ORDER BY nb_activites_total DESC, id_salarie LIMIT 20""",
    "active_details": f"""WITH {EMPLOYEES}, {TOTALS}
SELECT id_salarie, nom, prenom, moyen_deplacement, salaire_brut, nb_activites_excel,
       nb_activites_delta, nb_activites_total
FROM totals JOIN employees USING (id_salarie) WHERE nb_activites_total >= 15""",
    "active_and_eco": f"""WITH {EMPLOYEES}, {TOTALS}
SELECT id_salarie, nom, prenom, moyen_deplacement, salaire_brut, nb_activites_excel,
       nb_activites_delta, nb_activites_total
FROM totals JOIN employees e USING (id_salarie)
WHERE nb_activites_total >= 15 AND EXISTS (
    SELECT 1 FROM employees x WHERE x.id_salarie = e.id_salarie
    AND {is_eco('x.moyen_deplacement')})""",
    "employee_detail": f"""WITH {EMPLOYEES},
counts AS (SELECT CAST(o_custkey AS VARCHAR) AS id_salarie, count(*) AS n FROM orders GROUP BY 1)
SELECT e.id_salarie, e.nom, e.moyen_deplacement, {big('coalesce(n, 0)')} AS nb_activites,
       {is_eco('e.moyen_deplacement')} AS prime_eligible,
       CAST(CASE WHEN coalesce(n, 0) >= 15 THEN 5 ELSE 0 END AS INTEGER) AS jours_bien_etre
FROM employees e LEFT JOIN counts c ON e.id_salarie = c.id_salarie""",
    "wellbeing_days": f"""
SELECT CAST(user_id AS VARCHAR) AS id_salarie, CAST(year(ts) AS INTEGER) AS annee,
       {big('count(*)')} AS nb_activites,
       CAST(CASE WHEN count(*) >= 15 THEN 5 ELSE 0 END AS INTEGER) AS jours_bien_etre
FROM events GROUP BY 1, 2""",
    "activity_trend": f"""WITH {ACTIVITIES}
SELECT CAST(CAST(date_trunc('month', start_date) AS DATE) AS VARCHAR) AS mois, activity_type,
       {big('count(*)')} AS nb_activites,
       {dbl('sum(CAST(distance_m AS DECIMAL(18,2)))')} AS distance_totale_m
FROM activities GROUP BY 1, 2""",
    "latest_per_key": f"""WITH {VERSIONS}
SELECT id_salarie, salaire_brut, moyen_deplacement, version_date, version_no FROM latest""",
    "dedup_first": f"""WITH {VERSIONS}
SELECT id_salarie, salaire_brut, moyen_deplacement, version_date, version_no FROM versions
QUALIFY row_number() OVER (PARTITION BY id_salarie ORDER BY version_date, version_no) = 1""",
    "current_rows": """
SELECT id, op, o_orderdate, o_orderkey FROM (
    SELECT o_custkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'd' ELSE 'u' END AS op,
           o_orderdate, o_orderkey
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
) WHERE op <> 'd'""",
    "export_stats": f"WITH {EMPLOYEES} {bonus_stats('priced')}",
    "export_stats_all_versions": f"WITH {VERSIONS} {bonus_stats('versions')}",
    "export_stats_latest": f"WITH {VERSIONS} {bonus_stats('latest')}",
    "salary_by_mode": f"""WITH {VERSIONS}
SELECT moyen_deplacement,
       {dbl('CAST(round(avg(salaire), 2) AS DECIMAL(18,2))')} AS salaire_moyen,
       {big('count(*)')} AS nombre_employes
FROM latest GROUP BY 1""",
    "count_by_mode": f"""WITH {VERSIONS}
SELECT moyen_deplacement, {big('count(*)')} AS nombre_employes FROM latest GROUP BY 1""",
    "bonus_by_mode": f"""WITH {VERSIONS}
SELECT moyen_deplacement,
       {dbl('CAST(round(avg(prime_annuelle), 2) AS DECIMAL(18,2))')} AS prime_moyenne,
       {big('count(*)')} AS nombre_employes
FROM latest GROUP BY 1""",
    "sql_view_report": f"WITH {EMPLOYEES} {bonus_stats('priced')}",
    "eco_budget_sql": f"""WITH {EMPLOYEES}
SELECT {dbl('sum(prime_annuelle)')} AS budget_total_primes FROM priced WHERE prime_annuelle > 0""",
    "eco_budget": f"""WITH {EMPLOYEES}
SELECT {dbl('sum(prime_annuelle)')} AS budget_total_primes,
       {big('count(*)')} AS nombre_employes_ecologiques,
       {dbl('CAST(round(avg(prime_annuelle), 2) AS DECIMAL(18,2))')} AS prime_moyenne
FROM priced WHERE {is_eco('moyen_deplacement')}""",
    "eco_bonuses": f"""WITH {EMPLOYEES}
SELECT id_salarie, nom, moyen_deplacement, {dbl('prime_annuelle')} AS prime_annuelle
FROM priced WHERE {is_eco('moyen_deplacement')}""",
    "describe_stats": f"WITH {EMPLOYEES}"
    + describe("id_salarie", "TRY_CAST(id_salarie AS DOUBLE)")
    + "\nUNION ALL"
    + describe("moyen_deplacement", "TRY_CAST(moyen_deplacement AS DOUBLE)")
    + "\nUNION ALL"
    + describe("salaire", "CAST(salaire AS DOUBLE)")
    + "\nUNION ALL"
    + describe("prime_annuelle", "CAST(prime_annuelle AS DOUBLE)"),
    "distinct_values": f"WITH {VERSIONS} SELECT DISTINCT salaire_brut FROM versions",
    "kpi_overview": f"""WITH {EMPLOYEES}, {ACTIVITIES},
per_person AS (SELECT id_salarie, count(*) AS n FROM activities GROUP BY 1)
{kpi('nombre_employes', 'count(*)', 'priced')}
UNION ALL {kpi('employes_avec_prime', 'count(*) FILTER (WHERE prime_annuelle > 0)', 'priced')}
UNION ALL {kpi('budget_total_primes', 'sum(prime_annuelle)', 'priced')}
UNION ALL {kpi('nombre_activites', 'count(*)', 'activities')}
UNION ALL {kpi('employes_tres_actifs', 'count(*) FILTER (WHERE n >= 15)', 'per_person')}
UNION ALL {kpi('distance_totale_m', 'sum(CAST(distance_m AS DECIMAL(18,2)))', 'activities')}""",
    "salary_parse": f"""
WITH texts AS (
    SELECT c_custkey, CASE c_mktsegment
        WHEN 'MACHINERY' THEN CAST(c_acctbal AS VARCHAR)
        WHEN 'HOUSEHOLD' THEN '  ' || CAST(c_acctbal AS VARCHAR) || ' '
        WHEN 'BUILDING' THEN c_name
        WHEN 'AUTOMOBILE' THEN CAST(c_acctbal AS VARCHAR) || 'd'
        WHEN 'FURNITURE' THEN CASE WHEN c_nationkey > 3 THEN (c_nationkey + 1) || 'e1999' END END AS t
    FROM customer
),
parsed AS (
    SELECT c_custkey, CASE WHEN regexp_full_match(
        t, '\\s*[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)([eE][+-]?[0-9]+)?\\s*')
        THEN TRY_CAST(trim(t) AS DECIMAL(18,2)) END AS v, coalesce(t LIKE '%e1999', false) AS gross
    FROM texts
)
SELECT c_custkey, CASE WHEN NOT gross THEN {dbl('coalesce(v, 30000)')} END AS salaire,
       v IS NULL AND NOT gross AS defaut, gross AS hors_plage FROM parsed""",
    "title_case": f"SELECT doc_id, {title_case('text')} AS titre FROM documents",
    "mode_key": f"SELECT doc_id, {key_of('text')} AS cle FROM documents",
    "date_text": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS minute FROM events",
    "distance_by_city": f"""WITH {EMPLOYEES}
SELECT id_salarie, coalesce({city_distance('adresse')}, -1) AS distance_km FROM employees""",
    "distance_by_postcode": f"""WITH {EMPLOYEES}
SELECT id_salarie, coalesce({postcode_distance('adresse')}, 22.5) AS distance_km FROM employees""",
    "distance_fallback": f"""WITH {EMPLOYEES}, {MEASURED}
SELECT id_salarie, {dbl('distance_km')} AS distance_km FROM distances""",
    "commute_validate": f"""WITH {EMPLOYEES}, {BANDED}
SELECT id_salarie, nom, prenom, adresse, moyen_deplacement, {dbl('distance_km')} AS distance_km,
       {verdict('distance_km', 'moyen_deplacement')} AS validation_deplacement,
       {_quote(roles.COMPANY)} AS adresse_entreprise
FROM banded""",
    "commute_stats": f"""WITH {EMPLOYEES}, {MEASURED},
checked AS (
    SELECT distance_km, {verdict('distance_km', 'moyen_deplacement')} AS validation_deplacement
    FROM distances)
SELECT validation_deplacement, {big('count(*)')} AS nombre_employes,
       {dbl('round(avg(distance_km), 4)')} AS distance_moyenne_km
FROM checked GROUP BY 1""",
    "commute_errors": f"""
WITH rows AS (
    SELECT o_orderkey AS no, {CHEVAL} AS mode,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 10000 END AS km
    FROM orders),
checked AS (SELECT no, {verdict('km', 'mode')} AS validation_deplacement FROM rows)
SELECT * FROM checked
WHERE contains(validation_deplacement, 'Erreur:')
   OR contains(validation_deplacement, 'Mode non spécifié')""",
    "dq_dates": """
WITH rows AS (
    SELECT o_orderkey,
           CASE WHEN o_orderstatus = 'P' THEN '31/12/1970' ELSE '1996-06-30' END AS date_naissance,
           strftime(o_orderdate, '%Y-%m-%d')
               || CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE '' END AS date_embauche
    FROM orders)
SELECT o_orderkey, date_naissance, date_embauche,
       TRY_CAST(date_naissance AS DATE) IS NOT NULL AS naissance_valide,
       TRY_CAST(date_embauche AS DATE) IS NOT NULL AS embauche_valide,
       coalesce(TRY_CAST(date_naissance AS DATE) < TRY_CAST(date_embauche AS DATE)
                AND TRY_CAST(date_embauche AS DATE) <= DATE '2000-01-01', false) AS dates_coherentes
FROM rows""",
    "dq_salary": f"""WITH {EMPLOYEES}
SELECT id_salarie, salaire_brut, salaire BETWEEN 1000 AND 8000 AS salaire_dans_bareme
FROM employees""",
    "dq_required": f"""WITH {INCOMPLETE}
SELECT id_salarie, salaire_brut IS NOT NULL AND moyen_deplacement IS NOT NULL AS champs_complets
FROM incomplete""",
    "activity_distance_check": f"""WITH {ACTIVITIES}
SELECT activity_no, activity_type, distance_m / 1000 AS distance_km,
       coalesce(distance_m / 1000 <= CASE
           WHEN contains(lower(activity_type), 'marche') OR contains(lower(activity_type), 'running')
               THEN 15
           WHEN contains(lower(activity_type), 'vélo') OR contains(lower(activity_type), 'velo')
               OR contains(lower(activity_type), 'trottinette') THEN 25 END, true)
           AS distance_valide
FROM activities""",
    "stream_raw_kv": f"""WITH {FAULTY}
SELECT CAST(event_id AS VARCHAR) AS key, value FROM faulty""",
    "stream_cdc_activities": CDC_ACTIVITIES,
    "stream_cdc_employees": f"""WITH {INCOMPLETE}
SELECT id_salarie, salaire_brut, moyen_deplacement, nom, prenom,
       CAST(CAST(DATE '1970-01-01' + CAST(date_embauche AS INTEGER) AS DATE) AS VARCHAR)
           AS date_embauche,
       type_contrat, bu, {dbl('prime_annuelle')} AS prime_annuelle, salary_defaulted
FROM filled_priced WHERE CAST(id_salarie AS BIGINT) % 7 <> 0""",
    "stream_current_employees": f"""WITH {VERSIONS}
SELECT id_salarie, salaire_brut, coalesce(moyen_deplacement, 'Non spécifié') AS moyen_deplacement,
       {dbl('prime_annuelle')} AS prime_annuelle
FROM latest JOIN orders ON o_orderkey = version_no WHERE o_orderstatus <> 'P'""",
    "stream_alerts": """
SELECT CAST(user_id AS VARCHAR) AS id_salarie,
       '🎯 Nouvelle activité sportive!' || chr(10) || '👤 Employé: ' || user_id || chr(10)
       || '🏃 Type: ' || event_type || chr(10) || '📏 Distance: ' || CAST(value AS VARCHAR) || 'm'
       || chr(10) || '⏱️ Durée: ' || regexp_extract(props, '([0-9]+)', 1) || 's'
       || CASE WHEN event_type <> 'error' THEN chr(10) || '💬 Commentaire: ' || props ELSE '' END
           AS message
FROM events""",
    "csv_multiline": """
SELECT doc_id, lang, source, n_chars, replace(text, ', ', '";' || chr(13) || chr(10) || '"') AS text
FROM documents""",
    "csv_typed": """
SELECT lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS code, o_orderkey AS numero,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS prix, o_orderstatus = 'F' AS clos,
       strftime(o_orderdate, '%Y-%m-%d') AS jour, o_orderdate AS moment,
       CASE WHEN o_orderkey % 100 = 7 THEN 'n/a' ELSE CAST(o_orderkey AS VARCHAR) END AS mixte,
       CAST(NULL AS VARCHAR) AS vide
FROM orders""",
    "inferred_types": """
SELECT unnest(['code', 'numero', 'prix', 'clos', 'jour', 'moment', 'mixte', 'vide']) AS colonne,
       unnest(['string', 'bigint', 'double', 'boolean', 'date', 'timestamp',
               CASE WHEN max(o_orderkey % 100 = 7) THEN 'string' ELSE 'bigint' END, 'string']) AS type
FROM orders""",
    "schema_conflict": """
SELECT c_custkey,
       CASE c_nationkey % 4 WHEN 3 THEN CAST(c_acctbal AS VARCHAR)
            WHEN 2 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)
            ELSE CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS salaire,
       CASE WHEN c_nationkey % 2 = 1 THEN c_nationkey END AS c_nationkey
FROM customer""",
    "monthly_merged": f"""WITH {ACTIVITIES}
SELECT CAST(CAST(date_trunc('month', start_date) AS DATE) AS VARCHAR) AS mois, activity_type,
       {big('count(*)')} AS nb_activites,
       {dbl('sum(CAST(distance_m AS DECIMAL(18,2)))')} AS distance_totale_m, true AS employes_proches
FROM activities GROUP BY 1, 2""",
    "profile_merged": f"""
WITH rows AS (
    SELECT l_quantity, l_extendedprice, CASE WHEN l_orderkey % 5 > 0 THEN l_discount END AS l_discount,
           l_partkey
    FROM lineitem)
{' UNION ALL '.join(
    f"SELECT '{c}' AS colonne, {big('count(*)')} AS nombre, {big(f'count(*) - count({c})')} AS nuls, "
    f"{dbl(f'min({c})')} AS minimum, {dbl(f'max({c})')} AS maximum, true AS mediane_proche FROM rows"
    for c in ('l_quantity', 'l_extendedprice', 'l_discount', 'l_partkey'))}""",
    "distance_gazetteer": f"""
WITH d AS (
    SELECT doc_id, {place_words('text')} AS words,
           {place_words("doc_id % 9 || ' Rue du Port, ' || substr(text, CAST(1 + doc_id % 30 AS BIGINT), 60)")} AS address
    FROM documents WHERE text IS NOT NULL),
n AS (
    SELECT array_to_string(words[1:1 + doc_id % 3], ' ') AS name, min(doc_id) AS position
    FROM d GROUP BY 1 HAVING name <> ''),
f AS (
    SELECT doc_id, min(position) AS position
    FROM d JOIN n ON contains(' ' || array_to_string(address, ' ') || ' ', ' ' || name || ' ') GROUP BY 1)
SELECT CAST(d.doc_id AS VARCHAR) AS id_salarie, coalesce({dbl('position % 40 + 5')}, -1) AS distance_km
FROM d LEFT JOIN f USING (doc_id)""",
    "required_columns": f"""WITH {INCOMPLETE}
SELECT 'id_salarie' AS colonne, true AS presente, {big('count(id_salarie)')} AS remplis FROM incomplete
UNION ALL SELECT 'salaire_brut', true, {big('count(salaire_brut)')} FROM incomplete
UNION ALL SELECT 'moyen_deplacement', true, {big('count(moyen_deplacement)')} FROM incomplete
UNION ALL SELECT 'adresse', false, 0""",
    "stream_latest_report": f"""WITH {VERSIONS},
current AS (
    SELECT coalesce(moyen_deplacement, 'Non spécifié') AS moyen_deplacement, prime_annuelle
    FROM latest JOIN orders ON o_orderkey = version_no WHERE o_orderstatus <> 'P')
{bonus_stats('current')}""",
    "stream_once": CDC_ACTIVITIES,
    "stream_eligibility": f"""
SELECT CAST(user_id AS VARCHAR) AS id_salarie,
       CAST(year(ts) + CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS annee,
       {big('count(*)')} AS nb_activites,
       CAST(CASE WHEN count(*) >= 15 THEN 5 ELSE 0 END AS INTEGER) AS jours_bien_etre
FROM events WHERE event_id % 5 <> 0 GROUP BY 1, 2""",
    "stream_mode_report": f"WITH {INCOMPLETE} {bonus_stats('filled_priced')}",
}
SQL["bucketed_details"] = SQL["active_details"]
