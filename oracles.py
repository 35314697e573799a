"""DuckDB SQL oracles for the registered queries.

Written from the rules, independently of the Spark plans: each customer's month
series takes its state from the last monthly close by ASOF JOIN, the movement
follows from the sign of the change, and monthly figures are pivoted by category.
The three model inputs are derived from the driver tables (orders,
customer, nation) by the same mapping as ``tidemark.sources.fixture``.
Money is compared as DOUBLE, ratios rounded to 6 places, counts as BIGINT.
"""

COUNTRIES = ["NATION_3", "NATION_7", "NATION_12"]
INDUSTRIES = ["BUILDING", "MACHINERY"]
NAME_PATTERN = "customer#0000001[0-4]"
EXPECTED_PLANS = 5
ACCENTED_PATTERN = "cli\u00e9nt#0000001[0-4]"


def _in(values):
    return ", ".join("'" + v + "'" for v in values)


PRICE = """CAST(CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 199 WHEN '2' THEN 99
        WHEN '3' THEN 49 WHEN '4' THEN 29 ELSE 19 END AS DECIMAL(10,2))"""

INPUTS = f"""
sub_plans AS (
  SELECT DISTINCT o_orderpriority AS plan_id, substr(o_orderpriority, 3) AS plan_name,
    {PRICE} AS monthly_price, 'monthly' AS billing_cycle
  FROM orders),
sub_customers AS (
  SELECT concat('cust_', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS customer_id,
    c_name AS customer_name, (SELECT CAST(min(o_orderdate) AS DATE) FROM orders WHERE o_custkey = c_custkey) AS signup_date,
    n_name AS country, c_mktsegment AS industry,
    CASE WHEN c_acctbal < 4500 THEN 'SMB' WHEN c_acctbal < 8350 THEN 'Mid-Market'
         ELSE 'Enterprise' END AS company_size
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
sub_raw AS (
  SELECT concat('evt_', lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS event_id,
    concat('cust_', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS customer_id,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN NULL ELSE o_orderpriority END AS plan_id,
    CAST(o_orderdate AS DATE) AS event_date,
    CASE WHEN o_orderstatus = 'F' THEN CAST(0 AS DECIMAL(10,2)) ELSE {PRICE} END AS monthly_amount
  FROM orders),
sub_seq AS (
  SELECT *, lag(monthly_amount) OVER (PARTITION BY customer_id ORDER BY event_date, event_id) AS pa,
    lag(event_id) OVER (PARTITION BY customer_id ORDER BY event_date, event_id) AS pe
  FROM sub_raw),
sub_typed AS (
  SELECT *, CASE WHEN pe IS NULL THEN 'signup' WHEN monthly_amount = 0 THEN 'cancel'
       WHEN pa = 0 THEN 'reactivate' WHEN monthly_amount < pa THEN 'downgrade'
       ELSE 'upgrade' END AS event_type
  FROM sub_seq),
sub_events AS (
  SELECT event_id, customer_id, plan_id, event_type, event_date, monthly_amount FROM sub_typed)"""

MODEL = """
bounds AS (
  SELECT CAST(date_trunc('month', min(event_date)) AS DATE) AS first_month,
         CAST(date_trunc('month', max(event_date)) AS DATE) AS last_month FROM sub_events),
months AS (
  SELECT CAST(unnest(generate_series(CAST(first_month AS TIMESTAMP), CAST(last_month AS TIMESTAMP),
         INTERVAL 1 MONTH)) AS DATE) AS month_date FROM bounds),
closes AS (
  SELECT customer_id, CAST(date_trunc('month', event_date) AS DATE) AS closed,
    max({'day': event_date, 'id': event_id, 'amount': monthly_amount, 'plan': plan_id}) AS last_event
  FROM sub_events GROUP BY ALL),
customer_range AS (SELECT customer_id, min(closed) AS first_month FROM closes GROUP BY customer_id),
customer_months AS (
  SELECT customer_id, r.first_month, CAST(unnest(generate_series(CAST(r.first_month AS TIMESTAMP),
    CAST((SELECT last_month FROM bounds) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month_date
  FROM customer_range r),
state AS (
  SELECT g.customer_id, g.first_month, g.month_date,
    CAST(COALESCE(c.last_event.amount, 0) AS DECIMAL(10,2)) AS current_mrr, c.last_event.plan AS current_plan_id
  FROM customer_months g ASOF JOIN closes c ON g.customer_id = c.customer_id AND g.month_date >= c.closed),
mom AS (
  SELECT s.*, CAST(COALESCE(b.current_mrr, 0) AS DECIMAL(10,2)) AS prev_mrr, b.current_plan_id AS prev_plan_id
  FROM state s LEFT JOIN state b ON b.customer_id = s.customer_id AND b.month_date + INTERVAL 1 MONTH = s.month_date),
classified AS (
  SELECT *, current_mrr - prev_mrr AS mrr_change,
    CASE sign(current_mrr - prev_mrr)
      WHEN 0 THEN 'No Change'
      WHEN 1 THEN CASE WHEN prev_mrr > 0 THEN 'Expansion' WHEN prev_mrr < 0 THEN 'Inactive'
                       WHEN month_date > first_month THEN 'Reactivation' ELSE 'New' END
      ELSE CASE WHEN prev_mrr <= 0 OR current_mrr < 0 THEN 'Inactive'
                WHEN current_mrr = 0 THEN 'Churn' ELSE 'Contraction' END
    END AS mrr_category
  FROM mom),
mv AS (
  SELECT d.*, x.* EXCLUDE (customer_id, first_month),
    (SELECT plan_name FROM sub_plans WHERE plan_id = x.prev_plan_id) AS prev_plan_name,
    (SELECT plan_name FROM sub_plans WHERE plan_id = x.current_plan_id) AS current_plan_name
  FROM sub_customers d, classified x WHERE d.customer_id = x.customer_id)"""


def _by_month(rows):
    """Balances and the movement of each category per month of ledger rows."""
    return f"""SELECT month_date, starting_mrr, ending_mrr, active_customers, COALESCE("New", 0) AS new_mrr,
    COALESCE("Expansion", 0) AS expansion_mrr, COALESCE("Reactivation", 0) AS reactivation_mrr,
    COALESCE("Contraction", 0) AS contraction_mrr, COALESCE("Churn", 0) AS churn_mrr
  FROM (SELECT month_date, sum(prev_mrr) AS starting_mrr, sum(current_mrr) AS ending_mrr,
               count(*) FILTER (current_mrr > 0) AS active_customers FROM {rows} GROUP BY month_date)
  LEFT JOIN (PIVOT (SELECT month_date, mrr_category, mrr_change FROM {rows})
             ON mrr_category IN ('New', 'Expansion', 'Reactivation', 'Contraction', 'Churn')
             USING sum(mrr_change) GROUP BY month_date) USING (month_date)"""


def _kpis(monthly):
    return f"""SELECT month_date, CAST(ending_mrr AS DOUBLE) AS ending_mrr, CAST(starting_mrr AS DOUBLE) AS starting_mrr,
    active_customers,
    CASE WHEN active_customers > 0 THEN CAST(ending_mrr AS DOUBLE) / active_customers ELSE 0.0 END AS arpu,
    CASE WHEN starting_mrr > 0 THEN 100.0 * (CAST(starting_mrr + expansion_mrr + reactivation_mrr + contraction_mrr
         + churn_mrr AS DOUBLE) / CAST(starting_mrr AS DOUBLE)) ELSE 100.0 END AS nrr,
    CASE WHEN starting_mrr > 0 THEN 100.0 * (CAST(abs(contraction_mrr + churn_mrr) AS DOUBLE)
         / CAST(starting_mrr AS DOUBLE)) ELSE 0.0 END AS gross_churn,
    CAST(new_mrr AS DOUBLE) AS new_mrr, CAST(expansion_mrr AS DOUBLE) AS expansion_mrr,
    CAST(reactivation_mrr AS DOUBLE) AS reactivation_mrr, CAST(contraction_mrr AS DOUBLE) AS contraction_mrr,
    CAST(churn_mrr AS DOUBLE) AS churn_mrr
  FROM {monthly}"""


def _with_defaults(months, kpis):
    """The KPI row of every month of `months` (month_date), zeros and NRR 100 where there is none."""
    zero = ["ending_mrr", "starting_mrr", "arpu", "gross_churn", "new_mrr", "expansion_mrr", "reactivation_mrr",
            "contraction_mrr", "churn_mrr"]
    return f"""SELECT m.month_date, COALESCE(k.nrr, 100.0) AS nrr, COALESCE(k.active_customers, 0) AS active_customers,
    {', '.join(f'COALESCE(k.{c}, 0.0) AS {c}' for c in zero)}
  FROM {months} m LEFT JOIN {kpis} k ON k.month_date = m.month_date"""


def _deltas(kpis):
    """Each month of `kpis` against the month before."""
    return f"""SELECT k.month_date, k.ending_mrr,
        round(CASE WHEN COALESCE(p.ending_mrr, 0) > 0 THEN (k.ending_mrr - p.ending_mrr) / p.ending_mrr * 100
              ELSE 0.0 END, 6) AS delta_mrr_pct,
        k.active_customers, k.active_customers - COALESCE(p.active_customers, 0) AS delta_customers,
        round(k.arpu, 6) AS arpu,
        round(CASE WHEN COALESCE(p.arpu, 0) > 0 THEN (k.arpu - p.arpu) / p.arpu * 100 ELSE 0.0 END, 6)
          AS delta_arpu_pct,
        round(k.nrr, 6) AS nrr, round(k.nrr - COALESCE(p.nrr, 100.0), 6) AS delta_nrr,
        round(k.gross_churn, 6) AS gross_churn,
        round(k.gross_churn - COALESCE(p.gross_churn, 0.0), 6) AS delta_churn,
        COALESCE(p.ending_mrr, 0) > 0 AS has_prior
        FROM {kpis} k LEFT JOIN {kpis} p ON p.month_date + INTERVAL 1 MONTH = k.month_date"""


def _validators(rows, customers="sub_customers", plans="sub_plans"):
    """(check_name, violations) of the four validators over ledger rows."""
    return f"""SELECT 'mrr_reconciliation' AS check_name, count(*) AS violations FROM ({_by_month(rows)})
    WHERE ending_mrr - starting_mrr IS DISTINCT FROM new_mrr + expansion_mrr + reactivation_mrr + contraction_mrr + churn_mrr
  UNION ALL
  SELECT 'mrr_continuity', count(*) FROM (
    SELECT starting_mrr, row_number() OVER o AS n, lag(ending_mrr) OVER o AS before
    FROM ({_by_month(rows)}) WINDOW o AS (ORDER BY month_date)) WHERE n > 1 AND starting_mrr IS DISTINCT FROM before
  UNION ALL
  SELECT 'customer_counts', abs((SELECT count(DISTINCT customer_id) FROM {customers})
                                - (SELECT count(DISTINCT customer_id) FROM {rows}))
  UNION ALL
  SELECT 'referential_integrity', (SELECT n FROM ({_orphans(rows, "customer_id", customers, "customer_id")}))
    + (SELECT n FROM ({_orphans(rows, "current_plan_id", plans, "plan_id", "v.current_plan_id IS NOT NULL AND")}))"""


def _orphans(rows, key, parent, parent_key, only=""):
    return (f"SELECT count(*) AS n FROM {rows} v WHERE {only} NOT EXISTS "
            f"(SELECT 1 FROM {parent} d WHERE d.{parent_key} = v.{key})")


SEGMENT = f"country IN ({_in(COUNTRIES)}) AND industry IN ({_in(INDUSTRIES)})"

REPORTS = f"""
report AS (SELECT CAST(last_month - INTERVAL 1 MONTH AS DATE) AS month_date FROM bounds),
waterfall AS ({_by_month("mv")}),
kpis AS ({_kpis("waterfall")}),
segment_rows AS (SELECT * FROM mv WHERE {SEGMENT}),
segment_kpis AS ({_kpis(f'({_by_month("segment_rows")})')}),
kpi_report AS ({_with_defaults("report", "kpis")}),
trend AS (SELECT month_date, CAST(ending_mrr AS DOUBLE) AS ending_mrr, active_customers FROM waterfall),
checks AS ({_validators("mv")}),
broken AS (SELECT * REPLACE (CAST(CASE WHEN month(month_date) = 6 THEN prev_mrr + 1 ELSE prev_mrr END AS DECIMAL(10,2))
           AS prev_mrr) FROM mv),
few_customers AS (SELECT * FROM sub_customers WHERE industry = 'BUILDING'),
few_plans AS (SELECT * FROM sub_plans WHERE monthly_price > 40),
broken_checks AS ({_validators("broken", "few_customers", "few_plans")}),
mislabelled AS (SELECT * EXCLUDE (event_type), CASE substr(plan_id, 1, 1) WHEN '1' THEN 'signup' WHEN '2' THEN 'upgrade'
    WHEN '3' THEN 'downgrade' WHEN '4' THEN 'reactivate' ELSE 'cancel' END AS event_type FROM sub_typed)"""

HEAD = f"WITH {INPUTS},{MODEL},{REPORTS}\n"  # further tables are appended by the queries that read them

MONEY_MV = """customer_id, customer_name, country, industry, company_size, signup_date, month_date,
  CAST(prev_mrr AS DOUBLE) AS prev_mrr, CAST(current_mrr AS DOUBLE) AS current_mrr,
  CAST(mrr_change AS DOUBLE) AS mrr_change, mrr_category, prev_plan_id, prev_plan_name,
  current_plan_id, current_plan_name"""

WF_COLS = """month_date, CAST(starting_mrr AS DOUBLE) AS starting_mrr, CAST(ending_mrr AS DOUBLE) AS ending_mrr,
  CAST(new_mrr AS DOUBLE) AS new_mrr, CAST(expansion_mrr AS DOUBLE) AS expansion_mrr,
  CAST(reactivation_mrr AS DOUBLE) AS reactivation_mrr, CAST(contraction_mrr AS DOUBLE) AS contraction_mrr,
  CAST(churn_mrr AS DOUBLE) AS churn_mrr"""

KPI_COLS = """month_date, ending_mrr, starting_mrr, active_customers, round(arpu, 6) AS arpu,
  round(nrr, 6) AS nrr, round(gross_churn, 6) AS gross_churn, new_mrr, expansion_mrr, reactivation_mrr,
  contraction_mrr, churn_mrr"""

ACTIVITY = """SELECT customer_name, country, industry, company_size AS segment, prev_plan_name AS previous_plan,
  current_plan_name AS new_plan, CAST(mrr_change AS DOUBLE) AS mrr_change, mrr_category AS action_category
  FROM mv WHERE month_date = (SELECT month_date FROM report) AND mrr_category NOT IN ('No Change', 'Inactive')"""


def _checks_summary(names, checks="checks"):
    return (f"SELECT check_name, violations = 0 AS passed, CAST(violations AS BIGINT) AS violations "
            f"FROM {checks} WHERE check_name IN ({_in(names)})")


def _orphan_summary(name, orphans):
    return f"SELECT '{name}' AS check_name, n = 0 AS passed, CAST(n AS BIGINT) AS violations FROM ({orphans})"


def _rules(**counts):
    """One row per rule of its count; names written with two underscores for the dot."""
    parts = " UNION ALL ".join(f"SELECT '{k.replace('__', '.')}' AS rule, ({v}) AS n" for k, v in counts.items())
    return f"SELECT rule, CAST(n AS BIGINT) AS violations, n = 0 AS passed FROM ({parts})"


def _repeated(rows, key):
    return f"SELECT count(*) FROM (SELECT {key} FROM {rows} GROUP BY {key} HAVING count(*) > 1)"


def _shipments(compare, join):
    """Each order line with its customer's last event at (or before) the day of shipping; of a day the largest event counts."""
    return f"""SELECT s.customer_id, l_orderkey, l_linenumber, shipped, CAST(d.last_event.amount AS DOUBLE) AS monthly_amount,
        d.last_event.plan AS plan_id
      FROM (SELECT concat('cust_', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) AS customer_id, l_orderkey, l_linenumber,
                   CAST(l_shipdate AS DATE) AS shipped FROM lineitem JOIN orders ON o_orderkey = l_orderkey) s
      {join} (SELECT customer_id, event_date, max({{'id': event_id, 'amount': monthly_amount, 'plan': plan_id}}) AS last_event
              FROM sub_events GROUP BY ALL) d ON s.customer_id = d.customer_id AND s.shipped {compare} d.event_date"""


# Events that break every kind of rule, and what each of them breaks.
DEFECTIVE = """
defective_once AS (SELECT event_id, customer_id, plan_id, CASE substr(plan_id, 1, 1) WHEN '4' THEN 'renewal' WHEN '3' THEN NULL
    ELSE 'signup' END AS event_type, event_date, monthly_amount - 20 AS monthly_amount FROM sub_raw),
defective AS (SELECT * FROM defective_once UNION ALL SELECT * FROM defective_once WHERE event_id LIKE '%7'),
broken_events AS (SELECT event_id, list_filter([
    CASE WHEN event_type IS NULL THEN 'events.event_type.not_null' END,
    CASE WHEN event_type = 'renewal' THEN 'events.event_type.domain' END,
    CASE WHEN monthly_amount < 0 THEN 'events.monthly_amount.min' END,
    CASE WHEN event_id LIKE '%7' THEN 'events.event_id.unique' END,
    CASE WHEN customer_id NOT IN (SELECT customer_id FROM few_customers) THEN 'events.customer_id.fk' END,
    CASE WHEN plan_id IS NOT NULL AND plan_id NOT IN (SELECT plan_id FROM few_plans) THEN 'events.plan_id.fk' END],
    lambda r: r IS NOT NULL) AS rules FROM defective),
event_rule_counts AS (SELECT unnest(rules) AS rule FROM broken_events)"""

_EVENT_RULES = ["event_id.not_null", "customer_id.not_null", "event_type.not_null", "event_date.not_null", "monthly_amount.not_null",
                "event_type.domain", "monthly_amount.min", "event_id.unique", "customer_id.fk", "plan_id.fk"]


def _violation_counts():
    parts = [f"SELECT 'events.{r}' AS rule, (SELECT count(*) FROM event_rule_counts WHERE rule = 'events.{r}') AS n" for r in _EVENT_RULES]
    clean = ["plans.plan_id.not_null", "plans.plan_name.not_null", "plans.monthly_price.not_null", "plans.billing_cycle.not_null",
             "plans.billing_cycle.domain", "plans.plan_id.unique", "customers.customer_id.unique",
             *[f"customers.{c}.not_null" for c in ("customer_id", "customer_name", "country", "industry", "company_size")]]
    parts += [f"SELECT '{r}', 0" for r in clean]
    parts.append("SELECT 'customers.signup_date.not_null', (SELECT count(*) - count(signup_date) FROM few_customers)")
    parts.append("SELECT 'customers.company_size.domain', (SELECT count(*) FROM few_customers WHERE company_size = 'SMB')")
    return f"SELECT rule, CAST(n AS BIGINT) AS violating_rows, n = 0 AS passed FROM ({' UNION ALL '.join(parts)})"


ALL_CHECKS = ["mrr_reconciliation", "mrr_continuity", "customer_counts", "referential_integrity"]


QUERIES = {
    "month_bounds": "SELECT first_month, last_month FROM bounds",
    "month_spine": "SELECT month_date FROM months",
    "customer_range": "SELECT customer_id, first_month FROM customer_range",
    "customer_months": "SELECT customer_id, first_month, month_date FROM customer_months",
    "monthly_state": """SELECT customer_id, first_month, month_date, CAST(current_mrr AS DOUBLE) AS current_mrr,
        current_plan_id FROM state""",
    "month_over_month": """SELECT customer_id, first_month, month_date, CAST(current_mrr AS DOUBLE) AS current_mrr,
        current_plan_id, CAST(prev_mrr AS DOUBLE) AS prev_mrr, prev_plan_id FROM mom""",
    "classified_movements": """SELECT customer_id, month_date, CAST(current_mrr AS DOUBLE) AS current_mrr,
        CAST(prev_mrr AS DOUBLE) AS prev_mrr, current_plan_id, prev_plan_id,
        CAST(mrr_change AS DOUBLE) AS mrr_change, mrr_category FROM classified""",
    "movements": f"SELECT {MONEY_MV} FROM mv",
    "movements_composed": f"SELECT {MONEY_MV} FROM mv",
    "category_counts": "SELECT mrr_category, CAST(count(*) AS BIGINT) AS n_rows FROM mv GROUP BY mrr_category",
    "monthly_waterfall": f"SELECT {WF_COLS} FROM waterfall",
    "monthly_waterfall_fast": f"SELECT {WF_COLS} FROM waterfall",
    "check_reconciliation": _checks_summary(["mrr_reconciliation"]),
    "check_continuity": _checks_summary(["mrr_continuity"]),
    "check_customer_counts": _checks_summary(["customer_counts"]),
    "check_orphan_customers": f"""SELECT 'orphan_customers' AS check_name, n = 0 AS passed, CAST(n AS BIGINT) AS violations
        FROM ({_orphans("mv", "customer_id", "sub_customers", "customer_id")})""",
    "check_orphan_plans": f"""SELECT 'orphan_plans' AS check_name, n = 0 AS passed, CAST(n AS BIGINT) AS violations
        FROM ({_orphans("mv", "current_plan_id", "sub_plans", "plan_id", "v.current_plan_id IS NOT NULL AND")})""",
    "check_integrity": _checks_summary(["referential_integrity"]),
    "run_checks": f"""{_checks_summary(["mrr_reconciliation", "mrr_continuity", "customer_counts",
                                          "referential_integrity"])}
        UNION ALL SELECT 'all_checks', bool_and(violations = 0), CAST(sum(violations) AS BIGINT) FROM checks""",
    "validation_report": """SELECT check_name,
        CASE check_name WHEN 'mrr_reconciliation' THEN 'MRR Accounting Equation Balance'
          WHEN 'mrr_continuity' THEN 'Month-over-Month MRR Continuity'
          WHEN 'referential_integrity' THEN 'Referential Integrity Constraints'
          ELSE 'Customer Count Consistency' END AS validation_check,
        CASE check_name WHEN 'mrr_reconciliation'
            THEN 'Starting MRR + New + Expansion + Reactivation - Contraction - Churn = Ending MRR'
          WHEN 'mrr_continuity' THEN 'Current Starting MRR = Previous Ending MRR'
          WHEN 'referential_integrity' THEN 'Orphan customers count in movements = 0'
          ELSE 'Distinct active customer counts match dimensions' END AS constraint_formula,
        CASE WHEN check_name IN ('mrr_reconciliation', 'mrr_continuity') THEN '$0.00 (Zero Cent Margin)'
          WHEN check_name = 'referential_integrity' THEN '0 rows mismatch' ELSE '0 records offset' END
          AS tolerance,
        CASE WHEN violations = 0 THEN 'PASSED' ELSE 'FAILED' END AS status,
        CAST(violations AS BIGINT) AS violations FROM checks""",
    "monthly_kpis": f"SELECT {KPI_COLS} FROM kpis",
    "kpis_at_month": f"SELECT {KPI_COLS} FROM kpi_report",
    "kpis_prior_month": f"""SELECT {KPI_COLS} FROM kpis
        WHERE month_date = (SELECT CAST(month_date - INTERVAL 1 MONTH AS DATE) FROM report)""",
    "kpis_filtered": f"SELECT {KPI_COLS} FROM segment_kpis",
    "month_report": f"""SELECT r.* FROM ({_deltas("(" + _with_defaults("months", "segment_kpis") + ")")}) r
        WHERE r.month_date = (SELECT month_date FROM report)""",
    "kpis_at_empty_month": """SELECT CAST(last_month + INTERVAL 1 MONTH AS DATE) AS month_date,
        CAST(0 AS DOUBLE) AS ending_mrr, CAST(0 AS DOUBLE) AS starting_mrr, CAST(0 AS BIGINT) AS active_customers,
        CAST(0 AS DOUBLE) AS arpu, CAST(100 AS DOUBLE) AS nrr, CAST(0 AS DOUBLE) AS gross_churn,
        CAST(0 AS DOUBLE) AS new_mrr, CAST(0 AS DOUBLE) AS expansion_mrr, CAST(0 AS DOUBLE) AS reactivation_mrr,
        CAST(0 AS DOUBLE) AS contraction_mrr, CAST(0 AS DOUBLE) AS churn_mrr FROM bounds""",
    "kpi_deltas": _deltas("kpis"),
    "waterfall_steps": """SELECT month_date, step_order, step, measure, amount FROM kpi_report,
        (VALUES (1, 'Starting MRR', 'absolute'), (2, 'New MRR', 'relative'), (3, 'Expansion', 'relative'),
                (4, 'Reactivation', 'relative'), (5, 'Contraction', 'relative'), (6, 'Churn', 'relative'),
                (7, 'Ending MRR', 'total')) s(step_order, step, measure),
        LATERAL (SELECT CASE step_order WHEN 1 THEN starting_mrr WHEN 2 THEN new_mrr WHEN 3 THEN expansion_mrr
          WHEN 4 THEN reactivation_mrr WHEN 5 THEN contraction_mrr WHEN 6 THEN churn_mrr
          ELSE ending_mrr END AS amount) a""",
    "waterfall_equation": """SELECT month_date, starting_mrr, new_mrr + expansion_mrr + reactivation_mrr
        AS total_increases, abs(contraction_mrr + churn_mrr) AS total_decreases, ending_mrr FROM kpi_report""",
    "trend": "SELECT month_date, ending_mrr, active_customers FROM trend",
    "trend_filtered": "SELECT month_date, ending_mrr, active_customers FROM segment_kpis",
    "segment_trend": """SELECT month_date, company_size, CAST(sum(current_mrr) AS DOUBLE) AS ending_mrr,
        CAST(sum(prev_mrr) AS DOUBLE) AS starting_mrr,
        CAST(sum(CASE WHEN mrr_category = 'Churn' THEN mrr_change ELSE 0 END) AS DOUBLE) AS churn_mrr,
        CAST(sum(CASE WHEN current_mrr > 0 THEN 1 ELSE 0 END) AS BIGINT) AS active_customers,
        CAST(count(*) AS BIGINT) AS ledger_rows
        FROM mv GROUP BY month_date, company_size""",
    "growth_cagr": """SELECT CAST(n AS BIGINT) AS n_months,
        round(CASE WHEN n > 1 AND fm > 0 THEN (lm - fm) / fm * 100 ELSE 0.0 END, 6) AS mrr_growth_pct,
        round(CASE WHEN n > 1 AND fc > 0 THEN (lc - fc) / fc * 100 ELSE 0.0 END, 6) AS customer_growth_pct,
        round(CASE WHEN n > 1 AND fm > 0 AND lm > 0 THEN (pow(lm / fm, 1.0 / ((n - 1) / 12.0)) - 1) * 100
              ELSE 0.0 END, 6) AS mrr_cagr,
        round(CASE WHEN n > 1 AND fc > 0 AND lc > 0 THEN (pow(lc / fc, 1.0 / ((n - 1) / 12.0)) - 1) * 100
              ELSE 0.0 END, 6) AS customer_cagr
        FROM (SELECT count(*) AS n, arg_min(ending_mrr, month_date) AS fm, arg_max(ending_mrr, month_date) AS lm,
              CAST(arg_min(active_customers, month_date) AS DOUBLE) AS fc,
              CAST(arg_max(active_customers, month_date) AS DOUBLE) AS lc FROM trend) t""",
    "segment_mix": """SELECT company_size, CAST(sum(current_mrr) AS DOUBLE) AS mrr_contribution FROM mv
        WHERE month_date = (SELECT month_date FROM report) AND current_mrr > 0 GROUP BY company_size""",
    "activity_ledger": ACTIVITY,
    "ledger_search": ACTIVITY + f" AND regexp_matches(customer_name, '{NAME_PATTERN}', 'i')",
    "ledger_count": f"SELECT CAST(count(*) AS BIGINT) AS n_rows FROM ({ACTIVITY}) t",
    "segment_filter_count": f"SELECT CAST(count(*) AS BIGINT) AS n_rows FROM mv WHERE {SEGMENT}",
    "options_country": "SELECT DISTINCT country FROM mv",
    "options_industry": "SELECT DISTINCT industry FROM mv",
    "options_month": "SELECT DISTINCT month_date FROM mv",
    "read_plans": """SELECT plan_id, plan_name, CAST(monthly_price AS DOUBLE) AS monthly_price, billing_cycle
        FROM sub_plans""",
    "read_customers": "SELECT * FROM sub_customers",
    "read_events": """SELECT event_id, customer_id, plan_id, event_type, event_date,
        CAST(monthly_amount AS DOUBLE) AS monthly_amount FROM sub_events""",
    "conform_rejects": """SELECT 'plans' AS table_name, CAST(count(*) AS BIGINT) AS ok_rows,
          CAST(0 AS BIGINT) AS rejected_rows FROM sub_plans
        UNION ALL SELECT 'customers', count(*), 0 FROM sub_customers
        UNION ALL SELECT 'events', count(*), 0 FROM sub_events""",
    "load_check": """SELECT t AS table_name, CAST(n AS BIGINT) AS input_rows, CAST(n AS BIGINT) AS stored_rows,
        true AS passed FROM (SELECT 'plans' AS t, count(*) AS n FROM sub_plans
        UNION ALL SELECT 'customers', count(*) FROM sub_customers
        UNION ALL SELECT 'events', count(*) FROM sub_events) x""",
    "load_counts": """SELECT 'plans' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM sub_plans
        UNION ALL SELECT 'customers', count(*) FROM sub_customers
        UNION ALL SELECT 'events', count(*) FROM sub_events""",
    "derive_event_type": "SELECT event_id, customer_id, event_type FROM sub_events",
    "audit_lifecycle": """SELECT rule, CAST(count(*) AS BIGINT) AS violations FROM (
        SELECT CASE
          WHEN pe IS NULL AND event_type <> 'signup' THEN 'first_event_not_signup'
          WHEN pe IS NOT NULL AND event_type = 'signup' THEN 'signup_after_first_event'
          WHEN event_type = 'upgrade' AND NOT (COALESCE(pa > 0 AND monthly_amount >= pa, false))
            THEN 'upgrade_to_cheaper_plan_or_while_inactive'
          WHEN event_type = 'downgrade' AND NOT (COALESCE(pa > 0 AND monthly_amount < pa, false))
            THEN 'downgrade_not_to_cheaper_plan_while_active'
          WHEN event_type = 'cancel' AND NOT COALESCE(pa > 0, false) THEN 'cancel_while_inactive'
          WHEN event_type = 'reactivate' AND NOT COALESCE(pa = 0, false) THEN 'reactivate_without_cancel'
        END AS rule FROM sub_typed) t WHERE rule IS NOT NULL GROUP BY rule""",
    "audit_price": """SELECT rule, CAST(count(*) AS BIGINT) AS violations FROM (
        SELECT CASE
          WHEN e.event_type = 'cancel' AND e.monthly_amount <> 0 THEN 'cancel_with_amount'
          WHEN e.event_type <> 'cancel' AND e.plan_id IS NULL THEN 'active_without_plan'
          WHEN e.event_type <> 'cancel' AND p.monthly_price IS NULL THEN 'unknown_plan'
          WHEN e.event_type <> 'cancel' AND e.monthly_amount <> p.monthly_price THEN 'amount_not_plan_price'
        END AS rule FROM sub_events e LEFT JOIN sub_plans p ON e.plan_id = p.plan_id) t
        WHERE rule IS NOT NULL GROUP BY rule""",
    "check_unique_keys": """SELECT rule, CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'plans.plan_id.unique' AS rule, (SELECT count(*) FROM (SELECT plan_id FROM sub_plans
          WHERE plan_id IS NOT NULL GROUP BY plan_id HAVING count(*) > 1))
          + (SELECT count(*) FROM sub_plans WHERE plan_id IS NULL) AS v
        UNION ALL SELECT 'customers.customer_id.unique', (SELECT count(*) FROM (SELECT customer_id
          FROM sub_customers WHERE customer_id IS NOT NULL GROUP BY customer_id HAVING count(*) > 1))
          + (SELECT count(*) FROM sub_customers WHERE customer_id IS NULL)
        UNION ALL SELECT 'events.event_id.unique', (SELECT count(*) FROM (SELECT event_id FROM sub_events
          WHERE event_id IS NOT NULL GROUP BY event_id HAVING count(*) > 1))
          + (SELECT count(*) FROM sub_events WHERE event_id IS NULL)) t""",
    "check_not_null": """SELECT rule, CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'plans.plan_id.not_null' AS rule, count(*) - count(plan_id) AS v FROM sub_plans
        UNION ALL SELECT 'plans.plan_name.not_null', count(*) - count(plan_name) FROM sub_plans
        UNION ALL SELECT 'plans.monthly_price.not_null', count(*) - count(monthly_price) FROM sub_plans
        UNION ALL SELECT 'plans.billing_cycle.not_null', count(*) - count(billing_cycle) FROM sub_plans
        UNION ALL SELECT 'customers.customer_id.not_null', count(*) - count(customer_id) FROM sub_customers
        UNION ALL SELECT 'customers.customer_name.not_null', count(*) - count(customer_name) FROM sub_customers
        UNION ALL SELECT 'customers.signup_date.not_null', count(*) - count(signup_date) FROM sub_customers
        UNION ALL SELECT 'customers.country.not_null', count(*) - count(country) FROM sub_customers
        UNION ALL SELECT 'customers.industry.not_null', count(*) - count(industry) FROM sub_customers
        UNION ALL SELECT 'customers.company_size.not_null', count(*) - count(company_size) FROM sub_customers
        UNION ALL SELECT 'events.event_id.not_null', count(*) - count(event_id) FROM sub_events
        UNION ALL SELECT 'events.customer_id.not_null', count(*) - count(customer_id) FROM sub_events
        UNION ALL SELECT 'events.event_type.not_null', count(*) - count(event_type) FROM sub_events
        UNION ALL SELECT 'events.event_date.not_null', count(*) - count(event_date) FROM sub_events
        UNION ALL SELECT 'events.monthly_amount.not_null', count(*) - count(monthly_amount) FROM sub_events
        ) t""",
    "check_domains": """SELECT rule, CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'plans.billing_cycle.domain' AS rule, count(*) AS v FROM sub_plans
          WHERE billing_cycle NOT IN ('monthly')
        UNION ALL SELECT 'customers.company_size.domain', count(*) FROM sub_customers
          WHERE company_size NOT IN ('SMB', 'Mid-Market', 'Enterprise')
        UNION ALL SELECT 'events.event_type.domain', count(*) FROM sub_events
          WHERE event_type NOT IN ('signup', 'upgrade', 'downgrade', 'cancel', 'reactivate')
        UNION ALL SELECT 'events.monthly_amount.min', count(*) FROM sub_events WHERE monthly_amount < 0) t""",
    "check_foreign_keys": """SELECT rule, CAST(v AS BIGINT) AS violations, v = 0 AS passed FROM (
        SELECT 'events.customer_id.fk' AS rule, count(*) AS v FROM sub_events e
          WHERE e.customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sub_customers c
          WHERE c.customer_id = e.customer_id)
        UNION ALL SELECT 'events.plan_id.fk', count(*) FROM sub_events e
          WHERE e.plan_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM sub_plans p WHERE p.plan_id = e.plan_id)
        ) t""",
    "check_plan_count": f"""SELECT 'plans.row_count' AS rule, CAST(abs(count(*) - {EXPECTED_PLANS}) AS BIGINT)
        AS violations, count(*) = {EXPECTED_PLANS} AS passed FROM sub_plans""",
    "monthly_kpis_dense": f"SELECT {KPI_COLS} FROM kpis",
    "trend_dense": "SELECT month_date, ending_mrr, active_customers FROM trend",
    "movements_prior_month": f"""SELECT {MONEY_MV} FROM mv
        WHERE month_date = (SELECT CAST(month_date - INTERVAL 1 MONTH AS DATE) FROM report)""",
    "month_report_empty": f"""SELECT r.* FROM ({_deltas("(" + _with_defaults("months", "(SELECT * FROM kpis WHERE false)") + ")")}) r
        WHERE r.month_date = (SELECT month_date FROM report)""",
    "search_accented": f"""SELECT customer_id, replace(customer_name, 'Customer', 'CLI\u00c9NT') AS customer_name FROM sub_customers
        WHERE regexp_matches(replace(customer_name, 'Customer', 'CLI\u00c9NT'), '{ACCENTED_PATTERN}', 'i')""",
    "published_movements": f"SELECT {MONEY_MV} FROM mv",
    "published_counts": """SELECT 'dim_customers' AS table_name, count(*) AS row_count FROM sub_customers
        UNION ALL SELECT 'dim_plans', count(*) FROM sub_plans UNION ALL SELECT 'mrr_movements', count(*) FROM mv
        UNION ALL SELECT 'subscription_events', count(*) FROM sub_events""",
    "run_checks_broken": f"""{_checks_summary(ALL_CHECKS, "broken_checks")}
        UNION ALL SELECT 'all_checks', bool_and(violations = 0), CAST(sum(violations) AS BIGINT) FROM broken_checks""",
    "reconciliation_violations": f"""SELECT month_date, CAST(abs(starting_mrr + new_mrr + expansion_mrr + reactivation_mrr
        + contraction_mrr + churn_mrr - ending_mrr) AS DOUBLE) AS difference FROM ({_by_month("broken")})
        WHERE starting_mrr + new_mrr + expansion_mrr + reactivation_mrr + contraction_mrr + churn_mrr <> ending_mrr""",
    "continuity_violations": f"""SELECT b.month_date, CAST(b.starting_mrr AS DOUBLE) AS starting_mrr FROM ({_by_month("broken")}) b
        JOIN ({_by_month("broken")}) a ON a.month_date + INTERVAL 1 MONTH = b.month_date
        WHERE a.ending_mrr <> b.starting_mrr""",
    "check_reconciliation_broken": _checks_summary(["mrr_reconciliation"], "broken_checks"),
    "check_continuity_broken": _checks_summary(["mrr_continuity"], "broken_checks"),
    "check_customer_counts_broken": _checks_summary(["customer_counts"], "broken_checks"),
    "check_integrity_broken": _checks_summary(["referential_integrity"], "broken_checks"),
    "check_orphan_customers_broken": _orphan_summary("orphan_customers", _orphans(
        "broken", "customer_id", "few_customers", "customer_id")),
    "check_orphan_plans_broken": _orphan_summary("orphan_plans", _orphans(
        "broken", "current_plan_id", "few_plans", "plan_id", "v.current_plan_id IS NOT NULL AND")),
    "orphan_customer_rows": """SELECT customer_id, month_date FROM mv
        WHERE customer_id NOT IN (SELECT customer_id FROM few_customers)""",
    "conform_rejects_broken": """SELECT count(*) FILTER (plan_id NOT SIMILAR TO '[12].*') AS ok_rows,
        count(*) FILTER (plan_id SIMILAR TO '[12].*') AS rejected_rows FROM sub_plans""",
    "load_check_broken": """SELECT 'plans' AS table_name, count(*) AS input_rows,
        count(*) FILTER (plan_id NOT SIMILAR TO '[12].*') AS stored_rows,
        count(*) FILTER (plan_id SIMILAR TO '[12].*') = 0 AS passed FROM sub_plans""",
    "check_unique_broken": _rules(
        plans__billing_cycle__unique=_repeated("sub_plans", "billing_cycle"),
        customers__country__unique=_repeated("sub_customers", "country"),
        events__customer_id__unique=_repeated("sub_events", "customer_id")),
    "check_rows_broken": _rules(
        events__plan_id__not_null="SELECT count(*) - count(plan_id) FROM sub_events",
        events__event_id__not_null="SELECT count(*) - count(event_id) FROM sub_events",
        customers__industry__domain=f"SELECT count(*) FROM sub_customers WHERE industry NOT IN ({_in(INDUSTRIES)})",
        events__monthly_amount__min="SELECT count(*) FROM sub_events WHERE monthly_amount < 20",
        plans__monthly_price__range="SELECT count(*) FROM sub_plans WHERE monthly_price NOT BETWEEN 20 AND 100",
        plans__row_count="SELECT abs(count(*) - 3) FROM sub_plans"),
    "check_foreign_keys_broken": _rules(
        events__customer_id__fk="""SELECT count(*) FROM orders WHERE NOT EXISTS
            (SELECT 1 FROM supplier WHERE s_suppkey = o_custkey)""",
        events__plan_id__fk="""SELECT count(*) FROM sub_events e WHERE plan_id IS NOT NULL AND NOT EXISTS
            (SELECT 1 FROM few_plans p WHERE p.plan_id = e.plan_id)"""),
    "movements_clustered": f"SELECT {MONEY_MV} FROM mv",
    "published_at_month": f"SELECT {MONEY_MV} FROM mv WHERE month_date = (SELECT month_date FROM report)",
    "published_prior_month": f"""SELECT {MONEY_MV} FROM mv
        WHERE month_date = (SELECT CAST(month_date - INTERVAL 1 MONTH AS DATE) FROM report)""",
    "stored_event_range": "SELECT min(event_date) AS least, max(event_date) AS largest, count(*) AS n_rows FROM sub_events",
    "stored_month_options": "SELECT DISTINCT month_date FROM mv",
    "bound_segment_rows": f"SELECT {MONEY_MV} FROM segment_rows",
    "bound_segment_search": f"SELECT {MONEY_MV} FROM segment_rows WHERE regexp_matches(customer_name, '{NAME_PATTERN}', 'i')",
    "client_page": """SELECT customer_id, customer_name, country, CAST(mrr_change AS DOUBLE) AS mrr_change, mrr_category
        FROM mv WHERE month_date = (SELECT month_date FROM report) AND mrr_category NOT IN ('No Change', 'Inactive')
        ORDER BY country, customer_name, customer_id LIMIT 50 OFFSET 50""",
    "customer_coverage": """SELECT (SELECT count(*) FROM sub_customers) AS dimension_customers,
        (SELECT count(DISTINCT customer_id) FROM sub_raw) AS model_customers,
        (SELECT count(*) FROM sub_customers) = (SELECT count(DISTINCT customer_id) FROM sub_raw) AS passed""",
    "customer_differences": """SELECT customer_id, 'dimension' AS missing_in FROM (SELECT customer_id FROM mv
          EXCEPT SELECT customer_id FROM few_customers)
        UNION ALL SELECT customer_id, 'model' FROM (SELECT customer_id FROM few_customers EXCEPT SELECT customer_id FROM mv)""",
    "violating_events": "SELECT event_id, array_to_string(rules, ',') AS broken_rules FROM broken_events WHERE len(rules) > 0",
    "violation_counts": _violation_counts(),
    "asof_month_state": """SELECT customer_id, first_month, month_date, CAST(current_mrr AS DOUBLE) AS current_mrr,
        current_plan_id FROM state""",
    "asof_shipments": _shipments(">=", "ASOF LEFT JOIN"),
    "asof_shipments_before": _shipments(">", "ASOF JOIN"),
    "asof_snapshot": f"SELECT {MONEY_MV} FROM mv WHERE month_date = (SELECT month_date FROM report)",
    "asof_snapshot_year_before": f"""SELECT {MONEY_MV} FROM mv
        WHERE month_date = (SELECT CAST(month_date - INTERVAL 12 MONTH AS DATE) FROM report)""",
}

# The same rules over other inputs.
QUERIES["validation_report_broken"] = QUERIES["validation_report"].replace("FROM checks", "FROM broken_checks")
QUERIES["audit_lifecycle_broken"] = QUERIES["audit_lifecycle"].replace("sub_typed", "mislabelled")
QUERIES["audit_price_broken"] = QUERIES["audit_price"].replace("sub_events", "mislabelled").replace(
    "sub_plans", """(SELECT * REPLACE (CASE WHEN plan_id LIKE '4%' THEN 30 ELSE monthly_price END AS monthly_price)
        FROM sub_plans WHERE monthly_price < 100)""")


def oracle_sql() -> dict[str, str]:
    return {name: (HEAD.rstrip() + "," + DEFECTIVE + "\n" if name.startswith("violat") else HEAD) + body for name, body in QUERIES.items()}
