"""Independent SQL (DuckDB dialect) for every SQL-expressible query.

Each statement rebuilds the stand-in tables from the raw views with the same
integer rules as ``clinlake.plans.standins`` and computes the result without
any of the Spark operators.  Column names and types match the Spark output.
"""

from __future__ import annotations

COHORT_JOIN = """
  SELECT c.c_mktsegment AS seg, o.o_orderpriority AS prio, o.o_orderstatus AS st
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"""

DIAG = """
  SELECT p_partkey, p_name, p_type,
         CASE WHEN p_partkey % 7 = 0 THEN 'V' || CAST(p_size AS VARCHAR)
              WHEN p_partkey % 3 = 0 THEN CAST(p_size AS VARCHAR)
              ELSE lpad(CAST(p_size AS VARCHAR), 4, '0') END AS diag_code
  FROM part"""

CODE_JOIN = f"""
  d AS ({DIAG}),
  r AS (SELECT p_size, min(p_type) AS short_title, max(p_name) AS long_title FROM part GROUP BY p_size),
  cj AS (SELECT d.p_partkey, d.diag_code, CAST(r.p_size AS VARCHAR) AS proc_code, r.short_title, r.long_title
         FROM d JOIN r ON TRY_CAST(d.diag_code AS BIGINT) = CAST(r.p_size AS BIGINT))"""

_MIXED = """WITH m AS (SELECT dim, CASE WHEN dim % 2 = 0 THEN floor(v * 10) ELSE v END AS v
              FROM (SELECT CAST(unnest(embedding) AS DOUBLE) AS v, unnest(range(len(embedding))) AS dim FROM embeddings))"""

_CATEGORIES = """WITH o AS (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE 'c' || (o_orderkey // 4) END AS category FROM orders),
              k AS (SELECT "column", value, CAST(count(*) AS BIGINT) AS n,
                           row_number() OVER (PARTITION BY "column" ORDER BY count(*) DESC, value) - 1 AS code
                    FROM (SELECT 'category' AS "column", category AS value FROM o UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM o)
                    GROUP BY "column", value)"""

_COHORT = {
    "BUILDING": "seg = 'BUILDING'",
    "MACHINERY": "seg = 'MACHINERY'",
    "other": "seg NOT IN ('BUILDING', 'MACHINERY')",
}
_EVENT = {"urgent": "prio = '1-URGENT'", "finished": "st = 'F'"}


def _cohort_counts_sql() -> str:
    parts = [
        f"SELECT '{c}' AS cohort, '{e}' AS event, "
        f"CAST(count(*) FILTER (WHERE {cp} AND {ep}) AS BIGINT) AS n FROM j"
        for c, cp in _COHORT.items() for e, ep in _EVENT.items()
    ]
    return f"WITH j AS ({COHORT_JOIN})\n" + "\nUNION ALL\n".join(parts)


def oracle_sql() -> dict[str, str]:
    return {
        # ---- relational cohort analysis
        "cohort_counts": _cohort_counts_sql(),
        "inner_equi_join": """
            SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, o.o_orderpriority, o.o_orderstatus
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
        "code_join_numeric": f"WITH {CODE_JOIN} SELECT * FROM cj",
        "code_join_exact": f"""
            WITH d AS ({DIAG}),
                 r AS (SELECT lpad(CAST(p_size AS VARCHAR), 4, '0') AS proc_code, min(p_type) AS short_title,
                              max(p_name) AS long_title FROM part GROUP BY p_size)
            SELECT d.p_partkey, d.diag_code, r.proc_code, r.short_title, r.long_title
            FROM d JOIN r ON d.diag_code = r.proc_code""",
        "csv_scan_profiled": f"""WITH {STROKE_SRC}
            SELECT id, lpad(CAST(id AS VARCHAR), 7, '0') AS code, age, TRY_CAST(bmi AS DOUBLE) AS bmi, work_type, CAST(stroke AS BIGINT) AS stroke FROM s""",
        "checked_scan_good": """
            SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders
            WHERE o_orderkey % 60 <> 3 AND o_orderkey % 50 <> 1 AND o_orderkey % 70 <> 2""",
        "checked_scan_bad": """
            SELECT CASE WHEN o_orderkey % 60 = 3 THEN 'fields' WHEN o_orderkey % 70 = 2 THEN 'o_orderkey is missing' ELSE 'o_totalprice is no double' END AS reason,
                   CASE WHEN o_orderkey % 60 = 3 THEN o_orderkey || ',' || o_custkey
                        ELSE (CASE WHEN o_orderkey % 70 = 2 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END) || ',' || o_custkey || ','
                             || (CASE WHEN o_orderkey % 50 = 1 THEN '12.5 EUR' ELSE CAST(o_totalprice AS VARCHAR) END) || ',' || o_orderpriority END AS text
            FROM orders WHERE o_orderkey % 60 = 3 OR o_orderkey % 50 = 1 OR o_orderkey % 70 = 2""",
        "title_match_count": f"""WITH {CODE_JOIN}
            SELECT CAST(count(*) AS BIGINT) AS n FROM cj
            WHERE contains(short_title, 'al') OR contains(long_title, 'al')""",
        "text_match_count": """
            SELECT CAST(count(*) AS BIGINT) AS n FROM part
            WHERE contains(p_name, 'ring') OR contains(p_type, 'ring')""",
        # ---- size-graded scans
        "filter_item_threshold_count": """
            SELECT CAST(count(*) AS BIGINT) AS n FROM events WHERE user_id = 8 AND value >= 50""",
        "row_count": "SELECT CAST(count(*) AS BIGINT) AS n FROM events",
        "group_count_high_card": """
            SELECT l_partkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey""",
        "group_count_low_card": """
            SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type""",
        "preview_top_n": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 20",
        "csv_scan_typed": "SELECT * FROM orders",
        "csv_scan_inferred": """
            SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
                   o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
        "label_matrix_scan": """
            SELECT label, CAST(count(*) AS BIGINT) AS n, CAST(max(len(embedding)) AS INTEGER) AS dim,
                   round(sum(list_sum(list_transform(embedding, lambda x: CAST(CAST(x AS VARCHAR) AS DOUBLE)))), 4)
                     AS total
            FROM embeddings GROUP BY label""",
        **_more_sql(),
    }


# ---------------------------------------------------------------- stroke recipe

STROKE_SRC = """
  u AS (SELECT o_custkey AS c_custkey,
               count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent
        FROM orders GROUP BY o_custkey),
  s AS (SELECT c.c_custkey AS id,
          CASE WHEN c.c_nationkey % 10 = 9 THEN 'Other' WHEN c.c_custkey % 2 = 0 THEN 'Female'
               ELSE 'Male' END AS gender,
          CAST(c.c_custkey % 80 + 1 AS DOUBLE) AS age,
          CASE WHEN c.c_custkey % 5 = 0 THEN 1 ELSE 0 END AS hypertension,
          CASE WHEN c.c_nationkey % 4 = 0 THEN 1 ELSE 0 END AS heart_disease,
          CASE WHEN c.c_custkey % 3 = 0 THEN 'No' ELSE 'Yes' END AS ever_married,
          c.c_mktsegment AS work_type,
          CASE WHEN c.c_nationkey % 2 = 0 THEN 'Urban' ELSE 'Rural' END AS Residence_type,
          CAST(55 AS DOUBLE) + CAST((c.c_custkey * 53) % 2000 AS DOUBLE) / CAST(10 AS DOUBLE)
            AS avg_glucose_level,
          CASE WHEN c.c_custkey % 13 = 0 THEN 'N/A'
               ELSE CAST(15 + ((c.c_custkey * 37) % 300) // 10 AS VARCHAR) || '.'
                    || CAST(((c.c_custkey * 37) % 300) % 10 AS VARCHAR) END AS bmi,
          CASE WHEN c.c_custkey % 7 <= 2 THEN 'never smoked' WHEN c.c_custkey % 7 <= 4 THEN 'Unknown'
               WHEN c.c_custkey % 7 = 5 THEN 'formerly smoked' ELSE 'smokes' END AS smoking_status,
          CASE WHEN coalesce(u.n_urgent, 0) >= 3 THEN 1 ELSE 0 END AS stroke
        FROM customer c LEFT JOIN u ON c.c_custkey = u.c_custkey)"""

STROKE_CLEAN = STROKE_SRC + """,
  sc AS (SELECT id, gender, CAST(trunc(age) AS INTEGER) AS age, hypertension, heart_disease,
                ever_married, work_type, Residence_type,
                CAST(trunc(avg_glucose_level) AS INTEGER) AS avg_glucose_level,
                coalesce(CAST(trunc(TRY_CAST(bmi AS DOUBLE)) AS INTEGER), 28) AS bmi,
                smoking_status, stroke FROM s)"""

AGE_BAND = ("CASE WHEN age < 30 THEN 'Adult' WHEN age > 30 AND age < 40 THEN 'MiddleAge' "
            "ELSE 'OldAge' END")
STROKE_CATEGORICAL = ["age", "gender", "ever_married", "work_type", "smoking_status", "Residence_type"]
STROKE_FEATURES = ["gender_label", "age_label", "hypertension", "heart_disease", "ever_married_label",
                   "work_type_label", "Residence_type_label", "avg_glucose_level", "bmi",
                   "smoking_status_label"]


def _frequency_codes(src: str, cols: list[str]) -> str:
    """CTEs ``k_<c>(v, code)``: most frequent value -> 0, ties in value order."""
    return ",\n".join(
        f"  k_{c} AS (SELECT {c} AS v, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS INTEGER)"
        f" AS code FROM {src} GROUP BY {c})" for c in cols)


def _stroke_indexed() -> str:
    joins = " ".join(f"JOIN k_{c} ON sa.{c} = k_{c}.v" for c in STROKE_CATEGORICAL)
    codes = ", ".join(f"k_{c}.code AS {c}_label" for c in STROKE_CATEGORICAL)
    return (STROKE_CLEAN + f""",
  sa AS (SELECT * REPLACE ({AGE_BAND} AS age) FROM sc),
{_frequency_codes('sa', STROKE_CATEGORICAL)},
  si AS (SELECT sa.*, {codes} FROM sa {joins})""")


def _hash_bucket(key: str, seed: int = 42, modulus: int = 10000) -> str:
    return f"(('0x' || substr(md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), '<null>')), 1, 8))::BIGINT % {modulus})"


def _double_list(cols: list[str]) -> str:
    return "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in cols) + "]"


# ------------------------------------------------------------------- ICU recipe

ICU_NUMERIC = ["Age", "Gender", "ICUType", "Height", "Weight", "HR"]


def _nullify(c: str) -> str:
    if c == "Height":  # whole numbers
        return "nullif(Height, -1) AS Height"
    return (f"CASE WHEN isnan({c}) OR {c} IN (-1.0::DOUBLE, 'inf'::DOUBLE, '-inf'::DOUBLE) "
            f"THEN NULL ELSE {c} END AS {c}")


ICU_CLEAN = """
  src AS (SELECT o.o_orderkey AS RecordID,
            CASE WHEN o.o_orderkey % 17 = 0 THEN -1.0::DOUBLE WHEN o.o_orderkey % 53 = 0 THEN 'inf'::DOUBLE
                 ELSE CAST(16 + c.c_custkey % 75 AS DOUBLE) END AS Age,
            CAST(c.c_nationkey % 2 AS DOUBLE) AS Gender,
            CAST(1 + c.c_nationkey % 4 AS DOUBLE) AS ICUType,
            CAST(CASE WHEN o.o_orderkey % 11 = 0 THEN NULL WHEN o.o_orderkey % 97 = 0 THEN 0
                      ELSE 150 + o.o_custkey % 50 END AS INTEGER) AS Height,
            CASE WHEN o.o_orderkey % 11 = 1 THEN -1.0::DOUBLE
                 ELSE CAST(40 + o.o_orderkey % 80 AS DOUBLE) END AS Weight,
            CASE WHEN o.o_orderkey % 7 = 3 THEN NULL
                 ELSE 60.0::DOUBLE + CAST(o.o_orderkey % 600 AS DOUBLE) / 10.0::DOUBLE END AS HR,
            CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS in_hospital_death
          FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
  clean AS (SELECT RecordID, """ + ", ".join(_nullify(c) for c in ICU_NUMERIC) + """, in_hospital_death
            FROM src)"""

ICU_AGE_LABELS = "['<20', '20s', '30s', '40s', '50s', '60s', '70s', '80s', '90s']"

ICU_BINNED = ICU_CLEAN + f""",
  ab AS (SELECT clean.*,
           CASE WHEN Age IS NOT NULL THEN CAST(len(list_filter(edges, lambda e: e < Age)) AS INTEGER) END AS age_bin
         FROM clean, (SELECT list_transform(range(1, 9), lambda i: i * ((hi - lo) / 9) + lo) AS edges
                      FROM (SELECT min(Age) AS lo, max(Age) AS hi FROM clean)) st),
  ag AS (SELECT ab.*, {ICU_AGE_LABELS}[age_bin + 1] AS age_group FROM ab)"""

ICU_MEDIAN = """,
  med AS (SELECT median(Height) AS mh, median(Weight) AS mw FROM clean)"""

BMI = ("CASE WHEN Height * Height = 0 THEN NULL "
       "ELSE CAST(printf('%.2f', Weight / (Height * Height) * 10000.0::DOUBLE) AS DOUBLE) END")

BMI_GROUP = """CASE WHEN lo >= 18.5::DOUBLE OR hi <= 29.9::DOUBLE THEN error('bin edges must increase')
            WHEN bmi IS NULL OR bmi <= lo THEN NULL
            WHEN bmi <= 18.5::DOUBLE THEN 'Underweight' WHEN bmi <= 24.9::DOUBLE THEN 'Healthy'
            WHEN bmi <= 29.9::DOUBLE THEN 'Overweight' WHEN bmi <= hi THEN 'Obesity' END"""

ICU_PREPARED = ICU_BINNED + ICU_MEDIAN + f""",
  mf AS (SELECT RecordID, Age, Gender, ICUType, coalesce(CAST(Height AS DOUBLE), mh) AS Height, coalesce(Weight, mw) AS Weight,
                HR, in_hospital_death, age_group FROM ag, med),
  bm AS (SELECT mf.*, {BMI} AS bmi FROM mf),
  prep AS (SELECT RecordID, Age, Gender, ICUType, Height, Weight, HR, in_hospital_death, age_group,
                  {BMI_GROUP} AS bmi_group
           FROM bm, (SELECT min(bmi) AS lo, max(bmi) AS hi FROM bm) st)"""


def _class_mean_fill(src: str, cols: list[str], label: str = "in_hospital_death") -> tuple[str, str]:
    stats = ", ".join(f"avg({c}) FILTER (WHERE {label} = {k}) AS m_{c}_{k}" for c in cols for k in (0, 1))
    fills = {c: f"coalesce(CAST({c} AS DOUBLE), CASE {label} WHEN 0 THEN m_{c}_0 WHEN 1 THEN m_{c}_1 END)" for c in cols}
    return f"  means AS (SELECT {stats} FROM {src})", fills


def _class_mode_ctes(src: str, cols: list[str], label: str = "in_hospital_death") -> tuple[str, dict]:
    ctes = []
    fills = {}
    for c in cols:
        ctes.append(
            f"  mode_{c} AS (SELECT lab, v FROM (SELECT {label} AS lab, {c} AS v, row_number() OVER "
            f"(PARTITION BY {label} ORDER BY count(*) DESC, {c}) AS rn FROM {src} "
            f"WHERE {c} IS NOT NULL AND {label} IN (0, 1) GROUP BY {label}, {c}) WHERE rn = 1)")
        fills[c] = (f"coalesce({c}, (SELECT v FROM mode_{c} WHERE mode_{c}.lab = {src}.{label}))")
    return ",\n".join(ctes), fills


ICU_COLS = ["RecordID", "Age", "Gender", "ICUType", "Height", "Weight", "HR", "in_hospital_death",
            "age_group", "bmi_group"]


def _icu_imputed() -> str:
    means_cte, mean_fills = _class_mean_fill("prep", ["Age", "Height", "Weight", "HR"])
    sel1 = ", ".join(f"{mean_fills[c]} AS {c}" if c in mean_fills else c for c in ICU_COLS)
    mode_ctes, mode_fills = _class_mode_ctes("mi", ["Gender", "ICUType", "age_group", "bmi_group"])
    sel2 = ", ".join(f"{mode_fills[c]} AS {c}" if c in mode_fills else c for c in ICU_COLS)
    return (ICU_PREPARED + ",\n" + means_cte + f""",
  mi AS (SELECT {sel1} FROM prep, means WHERE in_hospital_death IN (0, 1)),
{mode_ctes},
  imp AS (SELECT {sel2} FROM mi WHERE in_hospital_death IN (0, 1)),
{_frequency_codes('imp', ['age_group', 'bmi_group'])},
  fi AS (SELECT imp.*, k_age_group.code AS age_group_label, k_bmi_group.code AS bmi_group_label
         FROM imp JOIN k_age_group ON imp.age_group = k_age_group.v
                  JOIN k_bmi_group ON imp.bmi_group = k_bmi_group.v)""")


# ------------------------------------------------------------ rule predictions

PREDS = """
  p AS (SELECT o_orderkey,
          CASE WHEN o_orderpriority <= '2-HIGH' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
          CASE WHEN o_totalprice > 250000 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
          o_totalprice AS score,
          [1.0::DOUBLE - least(o_totalprice / 500000.0::DOUBLE, 1.0::DOUBLE),
           least(o_totalprice / 500000.0::DOUBLE, 1.0::DOUBLE)] AS probability
        FROM orders)"""

CLASS_STATS = PREDS + """,
  cm AS (SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction),
  bl AS (SELECT label AS class, CAST(sum(n) AS BIGINT) AS support,
                CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS BIGINT) AS tp FROM cm GROUP BY label),
  bp AS (SELECT prediction AS class, CAST(sum(n) AS BIGINT) AS predicted FROM cm GROUP BY prediction),
  s0 AS (SELECT coalesce(bl.class, bp.class) AS class, coalesce(support, 0) AS support,
                coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted
         FROM bl FULL JOIN bp ON bl.class = bp.class),
  s1 AS (SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0::DOUBLE END AS precision,
                   CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0::DOUBLE END AS recall
         FROM s0),
  st AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                        ELSE 0.0::DOUBLE END AS f1 FROM s1)"""

AUC = PREDS + """,
  g AS (SELECT score AS s, count(*) FILTER (WHERE label = 1.0) AS pos, count(*) FILTER (WHERE label <> 1.0) AS neg
        FROM p WHERE score IS NOT NULL AND label IS NOT NULL GROUP BY score),
  r AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                  AS below FROM g),
  auc AS (SELECT sum(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + CAST(neg AS DOUBLE) / 2))
                 / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM r)"""


# ------------------------------------------------------------------ profiling

_TABLE_COLS = {
    "customer": [("c_custkey", 8), ("c_name", None), ("c_nationkey", 4), ("c_acctbal", 8),
                 ("c_mktsegment", None)],
    "orders": [("o_orderkey", 8), ("o_custkey", 8), ("o_orderstatus", None), ("o_totalprice", 8),
               ("o_orderdate", 8), ("o_orderpriority", None)],
    "part": [("p_partkey", 8), ("p_name", None), ("p_brand", None), ("p_type", None), ("p_size", 4),
             ("p_retailprice", 8)],
    "lineitem": [("l_orderkey", 8), ("l_partkey", 8), ("l_suppkey", 8), ("l_linenumber", 4),
                 ("l_quantity", 8), ("l_extendedprice", 8), ("l_discount", 8), ("l_tax", 8),
                 ("l_returnflag", None), ("l_linestatus", None), ("l_shipdate", 8)],
}


def _width(cols) -> str:
    return " + ".join(f"coalesce(strlen({c}), 0)" if w is None else f"CASE WHEN {c} IS NULL THEN 0 ELSE {w} END"
                      for c, w in cols)


def _nulls(cols) -> str:
    return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c, _ in cols)


def _profile_of(name: str, source: str, cols) -> str:
    return (f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, {len(cols)} AS n_columns, "
            f"CAST(coalesce(sum({_width(cols)}), 0) AS BIGINT) AS n_bytes, "
            f"CAST(coalesce(sum({_nulls(cols)}), 0) AS BIGINT) AS n_nulls FROM {source}")


def _profile_sql() -> str:
    return "\nUNION ALL\n".join(_profile_of(t, t, cols) for t, cols in _TABLE_COLS.items())


# --------------------------------------------------------------- model outputs

def _grid_sql(values: dict[str, list]) -> str:
    """All settings of a grid in order (the last parameter varies fastest), with
    their parameters as text in name order."""
    names = list(values)
    total = 1
    for v in values.values():
        total *= len(v)
    step, at = total, {}
    for n in names:
        step //= len(values[n])
        items = ", ".join(f"'{x}'" for x in values[n])
        at[n] = f"'{n}=' || [{items}][(setting // {step}) % {len(values[n])} + 1]"
    text = " || ', ' || ".join(at[n] for n in sorted(names))
    return (f"SELECT CAST(setting AS INTEGER) AS setting, {text} AS params, true AS metric_is_share "
            f"FROM (SELECT unnest(range({total})) AS setting)")


def _model_sql() -> dict[str, str]:
    facts = "1.0::DOUBLE AS probability_sum, true AS prediction_is_argmax"
    stroke = f"""WITH {STROKE_SRC}
            SELECT id, CAST(stroke AS DOUBLE) AS label, 2 AS n_classes, {facts}, true AS score_is_positive
            FROM s WHERE {_hash_bucket('id')} >= 8000"""
    waveform = f"""
            WITH k AS (SELECT label, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(label AS VARCHAR)) - 1 AS DOUBLE) AS code
                       FROM embeddings GROUP BY label)
            SELECT vec_id, code AS label, CAST((SELECT count(*) FROM k) AS INTEGER) AS n_classes, {facts}
            FROM embeddings JOIN k USING (label) WHERE {_hash_bucket('vec_id')} >= 7000"""
    return {
        "logistic_predictions": stroke,
        "forest_predictions": stroke,
        "icu_predictions": f"""WITH {ICU_CLEAN}
            SELECT RecordID, CAST(in_hospital_death AS DOUBLE) AS label, 2 AS n_classes, {facts}, true AS score_is_positive
            FROM clean WHERE {_hash_bucket('RecordID')} >= 8000""",
        "tree_predictions": waveform,
        "boosted_predictions": f"""
            SELECT vec_id, CAST(label AS DOUBLE) AS label, CAST((SELECT max(label) + 1 FROM embeddings) AS INTEGER) AS n_classes, {facts}
            FROM embeddings WHERE {_hash_bucket('vec_id')} >= 7000""",
        "out_of_fold_predictions": f"""WITH {STROKE_SRC}
            SELECT id, CAST({_hash_bucket('id', 42, 3)} AS INTEGER) AS fold, CAST(stroke AS DOUBLE) AS label, 2 AS n_classes, {facts} FROM s""",
        "fold_split": f"""WITH {STROKE_SRC}
            SELECT id, key, CAST({_hash_bucket('key', 42, 3)} AS INTEGER) AS fold FROM (SELECT id, CASE WHEN id % 50 <> 0 THEN id END AS key FROM s)""",
        "fold_leaderboard": _grid_sql({"regParam": [0.01, 0.1], "maxIter": [5]}),
        "multinomial_predictions": waveform,
        "mlp_predictions": f"""
            SELECT CAST(label AS DOUBLE) AS label, CAST(count(*) AS BIGINT) AS n, 10 AS n_classes, 0.0::DOUBLE AS probability_gap,
                   true AS prediction_is_argmax
            FROM embeddings WHERE {_hash_bucket('vec_id')} >= 8000 GROUP BY label""",
        "network_predictions": f"""
            SELECT CAST(label AS DOUBLE) AS label, CAST(count(*) AS BIGINT) AS n, 10 AS n_classes, 0.0::DOUBLE AS probability_gap,
                   true AS prediction_is_argmax
            FROM embeddings WHERE {_hash_bucket('vec_id')} >= 8000 GROUP BY label""",
        # 32 rows a step, three epochs, each going on where the one before stopped
        "cyclic_batches": """
            WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS row, count(*) OVER () AS n FROM embeddings),
            s AS (SELECT greatest(1, count(*) // 32) AS steps FROM embeddings),
            g AS (SELECT unnest(range(0, 3 * steps * 32)) AS g, steps FROM s)
            SELECT CAST(g // (steps * 32) AS BIGINT) AS epoch, CAST((g // 32) % steps AS BIGINT) AS step, CAST(g % 32 AS BIGINT) AS place, vec_id
            FROM g JOIN r ON r.row = g.g % r.n""",
        "tuning_leaderboard": _grid_sql({"regParam": [0.01, 0.1], "maxIter": [5, 10], "tol": ["0.0001", "1e-05"],
                                         "elasticNetParam": [0.25, 0.75]}),
        "forest_leaderboard": _grid_sql({"maxDepth": [5, 10, 20], "maxBins": [20, 32, 50], "numTrees": [20, 40, 60],
                                         "impurity": ["gini", "entropy"], "minInstancesPerNode": [1, 5, 10]}),
        # vec_id, label, prediction and one probability per class
        "scored_size": f"""
            SELECT CAST(count(*) AS BIGINT) AS n_rows,
                   CAST(count(*) * (24 + 8 * (SELECT count(DISTINCT label) FROM embeddings)) AS BIGINT) AS n_bytes
            FROM embeddings WHERE {_hash_bucket('vec_id')} >= 7000""",
    }


def _impute_group_mean_sql() -> str:
    cols = ["Age", "Height", "Weight", "HR"]
    means_cte, fills = _class_mean_fill("clean", cols)
    selected = ", ".join(f"round({fills[c]}, 6) AS {c}" for c in cols)
    return f"""WITH {ICU_CLEAN},
            {means_cte}
            SELECT RecordID, in_hospital_death AS "In-hospital_death", {selected}
            FROM clean, means WHERE in_hospital_death IN (0, 1)"""


def _impute_group_mode_sql() -> str:
    cols = ["Gender", "ICUType", "age_group", "bmi_group"]
    mode_ctes, fills = _class_mode_ctes("prep", cols)
    selected = ", ".join(f"{fills[c]} AS {c}" for c in cols)
    return f"""WITH {ICU_PREPARED},
            {mode_ctes}
            SELECT RecordID, in_hospital_death AS "In-hospital_death", {selected}
            FROM prep WHERE in_hospital_death IN (0, 1)"""


def _more_sql() -> dict[str, str]:
    feats = _double_list(STROKE_FEATURES)
    original = ["RecordID", "Age", "Gender", "ICUType", "Height", "Weight", "HR", "age_group_label", "bmi_group_label",
                "age_group_label", "bmi_group_label"]
    icu_feats = ["Age", "Gender", "ICUType", "Height", "Weight", "HR", "age_group_label", "bmi_group_label"]
    return {
        "table_size": f"""
            SELECT CAST(count(*) AS BIGINT) AS n_rows,
                   CAST(coalesce(sum({_width(_TABLE_COLS['orders'])}), 0) AS BIGINT) AS n_bytes FROM orders""",
        "profile_tables": _profile_sql(),
        # o_orderkey, price, balance and status joined; key, label and two features assembled; key, label, prediction, two probabilities and score
        "observed_sizes": f"""
            WITH j AS (SELECT o_orderstatus FROM orders JOIN customer ON o_custkey = c_custkey)
            SELECT 'orders' AS step, CAST(count(*) AS BIGINT) AS n_rows, CAST(coalesce(sum({_width(_TABLE_COLS['orders'])}), 0) AS BIGINT) AS n_bytes FROM orders
            UNION ALL SELECT 'customer', CAST(count(*) AS BIGINT), CAST(coalesce(sum({_width(_TABLE_COLS['customer'])}), 0) AS BIGINT) FROM customer
            UNION ALL SELECT 'joined', CAST(count(*) AS BIGINT), CAST(sum(24 + strlen(o_orderstatus)) AS BIGINT) FROM j
            UNION ALL SELECT 'assembled', CAST(count(*) AS BIGINT), CAST(count(*) * 32 AS BIGINT) FROM j
            UNION ALL SELECT 'scored', CAST(count(*) AS BIGINT), CAST(count(*) * 48 AS BIGINT) FROM j""",
        "joined_sizes": f"""WITH {CODE_JOIN},
              oj AS (SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, o.o_orderpriority, o.o_orderstatus
                     FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)
            {_profile_of('cohort_join', 'oj', [('o_orderkey', 8), ('o_custkey', 8), ('c_mktsegment', None),
                                               ('o_orderpriority', None), ('o_orderstatus', None)])}
            UNION ALL
            {_profile_of('code_join', 'cj', [('p_partkey', 8), ('diag_code', None), ('proc_code', None),
                                             ('short_title', None), ('long_title', None)])}""",
        # id, eight int codes, two more ints, the label and a vector of ten doubles
        "assembled_size": """
            SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) * (8 + 10 * 4 + 4 + 80) AS BIGINT) AS n_bytes FROM customer""",
        # stroke
        "tolerant_int_cast": f"""WITH {STROKE_SRC}
            SELECT id, bmi, CAST(trunc(TRY_CAST(bmi AS DOUBLE)) AS INTEGER) AS bmi_int,
                   CAST(trunc(age) AS INTEGER) AS age_int,
                   CAST(trunc(avg_glucose_level) AS INTEGER) AS glucose_int FROM s""",
        "constant_fill": f"WITH {STROKE_CLEAN} SELECT id, bmi FROM sc",
        "interaction_features": f"""WITH {STROKE_CLEAN}
            SELECT id, CAST(hypertension AS BIGINT) * CAST(heart_disease AS BIGINT) AS "Blood&Heart",
                   CAST(bmi AS DOUBLE) * CAST(avg_glucose_level AS DOUBLE) / 1000.0::DOUBLE AS "Obesity" FROM sc""",
        "case_bucket": f"WITH {STROKE_CLEAN} SELECT id, age, {AGE_BAND} AS age_group FROM sc",
        "index_categories": f"""WITH {_stroke_indexed()}
            SELECT id, {', '.join(c + '_label' for c in STROKE_CATEGORICAL)} FROM si""",
        "assemble_features": f"""WITH {STROKE_SRC}
            SELECT id, {_double_list(['age', 'hypertension', 'heart_disease', 'avg_glucose_level'])} AS features
            FROM s""",
        "feature_table_case": f"""WITH {_stroke_indexed()}
            SELECT id, {', '.join(STROKE_FEATURES)}, stroke, {feats} AS features FROM si""",
        "split_80_20": f"""
            SELECT *, CASE WHEN {_hash_bucket('key')} < 8000 THEN 'train' ELSE 'test' END AS part
            FROM (SELECT c_custkey AS id, CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS key FROM customer)""",
        # ICU
        "sentinel_to_null": f"WITH {ICU_CLEAN} SELECT * RENAME (in_hospital_death AS \"In-hospital_death\") FROM clean",
        "equal_width_bin": f"WITH {ICU_BINNED} SELECT RecordID, Age, age_bin, age_group FROM ag",
        "impute_median": f"""WITH {ICU_CLEAN}{ICU_MEDIAN}
            SELECT RecordID, round(coalesce(CAST(Height AS DOUBLE), mh), 6) AS Height, round(coalesce(Weight, mw), 6) AS Weight
            FROM clean, med""",
        "ratio_round": f"""WITH {ICU_CLEAN}{ICU_MEDIAN},
              mf AS (SELECT RecordID, coalesce(CAST(Height AS DOUBLE), mh) AS Height, coalesce(Weight, mw) AS Weight
                     FROM clean, med)
            SELECT RecordID, {BMI} AS bmi FROM mf""",
        "edge_bin": f"""WITH {ICU_CLEAN}{ICU_MEDIAN},
              mf AS (SELECT RecordID, coalesce(CAST(Height AS DOUBLE), mh) AS Height, coalesce(Weight, mw) AS Weight
                     FROM clean, med),
              bm AS (SELECT RecordID, {BMI} AS bmi FROM mf)
            SELECT RecordID, bmi, {BMI_GROUP} AS bmi_group
            FROM bm, (SELECT min(bmi) AS lo, max(bmi) AS hi FROM bm) st""",
        "impute_group_mean": _impute_group_mean_sql(),
        "impute_group_mode": _impute_group_mode_sql(),
        "union_by_name": f"""WITH {ICU_CLEAN}
            SELECT * RENAME (in_hospital_death AS "In-hospital_death") FROM clean WHERE in_hospital_death IN (0, 1)""",
        "seeded_shuffle_rank": """
            SELECT o.o_orderkey AS RecordID,
                   CAST(row_number() OVER (ORDER BY ('0x' || substr(md5('42:' || CAST(o.o_orderkey AS VARCHAR)),
                                                                    1, 15))::BIGINT, o.o_orderkey) AS BIGINT)
                     AS shuffle_rank
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
        "feature_table_impute": f"""WITH {_icu_imputed()}
            SELECT RecordID, in_hospital_death AS "In-hospital_death",
                   list_transform({_double_list(icu_feats)}, lambda x: round(x, 6)) AS features FROM fi""",
        "feature_table_original": f"""WITH {_icu_imputed()}
            SELECT RecordID, in_hospital_death AS "In-hospital_death",
                   list_transform({_double_list(original)}, lambda x: round(x, 6)) AS features FROM fi""",
        # waveform
        "vector_index_cardinality": """
            SELECT CAST(dim AS INTEGER) AS dim,
                   CASE WHEN count(DISTINCT v) <= 100 THEN CAST(count(DISTINCT v) AS BIGINT) END AS n_values,
                   count(DISTINCT v) <= 100 AS is_categorical
            FROM (SELECT unnest(embedding) AS v, unnest(range(len(embedding))) AS dim FROM embeddings)
            GROUP BY dim""",
        "vector_distinct_count": """
            SELECT CAST(dim AS INTEGER) AS dim, CAST(count(DISTINCT v) AS BIGINT) AS n_distinct
            FROM (SELECT unnest(embedding) AS v, unnest(range(len(embedding))) AS dim FROM embeddings)
            GROUP BY dim""",
        "vector_category_flags": f"""{_MIXED}
            SELECT CAST(dim AS INTEGER) AS dim, CASE WHEN count(DISTINCT v) <= 100 THEN CAST(count(DISTINCT v) AS BIGINT) END AS n_values,
                   count(DISTINCT v) <= 100 AS is_categorical
            FROM m GROUP BY dim""",
        "vector_category_maps": f"""{_MIXED}
            SELECT CAST(dim AS INTEGER) AS dim, v AS value,
                   CAST(row_number() OVER (PARTITION BY dim ORDER BY v <> 0, v) - 1 AS INTEGER) AS code
            FROM (SELECT DISTINCT dim, v FROM m) WHERE dim IN (SELECT dim FROM m GROUP BY dim HAVING count(DISTINCT v) <= 100)""",
        "category_dictionary": f"""{_CATEGORIES} SELECT "column", value, n, code FROM k""",
        "category_codes": f"""{_CATEGORIES}
            SELECT o_orderkey, CAST(a.code AS INTEGER) AS category_label, CAST(b.code AS INTEGER) AS o_orderpriority_label
            FROM o JOIN k a ON a."column" = 'category' AND a.value = category JOIN k b ON b."column" = 'o_orderpriority' AND b.value = o_orderpriority""",
        "split_70_30": f"""
            SELECT *, CASE WHEN {_hash_bucket('key')} < 7000 THEN 'train' ELSE 'test' END AS part
            FROM (SELECT vec_id, CASE WHEN vec_id % 30 <> 0 THEN vec_id END AS key FROM embeddings)""",
        # metrics
        "confusion_matrix": f"WITH {PREDS} SELECT label, prediction, count(*) AS n FROM p GROUP BY label, prediction",
        "classification_metrics": f"""WITH {CLASS_STATS}
            SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 6) AS accuracy,
                   round(sum(precision * support) / sum(support), 6) AS weighted_precision,
                   round(sum(recall * support) / sum(support), 6) AS weighted_recall,
                   round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM st""",
        "classification_report": f"""WITH {CLASS_STATS}
            SELECT ['routine', 'priority'][CAST(class AS INTEGER) + 1] AS row_name, round(precision, 6) AS precision,
                   round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM st
            UNION ALL SELECT 'accuracy', NULL, NULL, round(CAST(sum(tp) AS DOUBLE) / sum(support), 6),
                   CAST(sum(support) AS BIGINT) FROM st
            UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
                   CAST(sum(support) AS BIGINT) FROM st
            UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
                   round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
                   CAST(sum(support) AS BIGINT) FROM st""",
        "auc_roc": f"WITH {AUC} SELECT round(auc, 6) AS auc FROM auc",
        "roc_curve": f"""WITH {PREDS},
            g AS (SELECT floor(score / 100) AS s, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label <> 1) AS neg FROM p GROUP BY 1),
            r AS (SELECT *, sum(pos) OVER u AS tp, sum(neg) OVER u AS fp, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
                         sum(pos) OVER () AS p_all, sum(neg) OVER () AS n_all
                  FROM g WINDOW w AS (ORDER BY s DESC), u AS (ORDER BY s DESC ROWS UNBOUNDED PRECEDING))
            SELECT 'inf'::DOUBLE AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr
            UNION ALL SELECT CAST(s AS DOUBLE), CAST(fp AS DOUBLE) / CAST(n_all AS DOUBLE), CAST(tp AS DOUBLE) / CAST(p_all AS DOUBLE)
            FROM r WHERE next_pos IS NULL OR pos * next_neg <> neg * next_pos""",
        "exact_quantiles": " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", {p}::DOUBLE AS probability, CAST(quantile_disc({c}, {p}) AS DOUBLE) AS value FROM orders"
            for c in ("o_totalprice", "o_custkey") for p in [i / 10 for i in range(11)]),
        "quantile_bins": """
            WITH e AS (SELECT list_distinct(quantile_disc(o_totalprice, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS a,
                              list_distinct(quantile_disc(o_custkey, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS b FROM orders)
            SELECT o_orderkey, CAST(len(list_filter(a, lambda x: x <= o_totalprice)) AS INTEGER) AS o_totalprice_bin,
                   CAST(len(list_filter(b, lambda x: x <= o_custkey)) AS INTEGER) AS o_custkey_bin
            FROM orders, e""",
        "binary_scorecard": f"""WITH {CLASS_STATS},
            {AUC.replace(PREDS + ',', '')}
            SELECT round(CAST(sum(tp) AS DOUBLE) / sum(support), 4) AS accuracy,
                   round(sum(precision * support) / sum(support), 4) AS precision,
                   round(min(auc.auc), 4) AS roc_auc FROM st, auc""",
        "misclassified_rows": f"""WITH {PREDS}
            SELECT o_orderkey, prediction, label, probability FROM p WHERE prediction <> label""",
        **_model_sql(),
        "argmax_array": """
            SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS argmax
            FROM embeddings""",
    }
