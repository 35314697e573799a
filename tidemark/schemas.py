"""Input and model schemas, and the fixed value domains of the model."""

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# The movement categories, in the order the classification tests them.
NO_CHANGE = "No Change"
NEW = "New"
REACTIVATION = "Reactivation"
EXPANSION = "Expansion"
CONTRACTION = "Contraction"
CHURN = "Churn"
INACTIVE = "Inactive"
CATEGORIES = [NO_CHANGE, NEW, REACTIVATION, EXPANSION, CONTRACTION, CHURN, INACTIVE]
# Categories that carry money into the waterfall, in report order.
WATERFALL_CATEGORIES = [NEW, EXPANSION, REACTIVATION, CONTRACTION, CHURN]
# Categories hidden from the activity ledger.
QUIET_CATEGORIES = [NO_CHANGE, INACTIVE]

# Declared domains of the input tables.
EVENT_TYPES = ["signup", "upgrade", "downgrade", "cancel", "reactivate"]
COMPANY_SIZES = ["SMB", "Mid-Market", "Enterprise"]
BILLING_CYCLES = ["monthly"]

PLANS = T.StructType([
    T.StructField("plan_id", T.StringType(), False),
    T.StructField("plan_name", T.StringType(), False),
    T.StructField("monthly_price", MONEY, False),
    T.StructField("billing_cycle", T.StringType(), False),
])

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("customer_name", T.StringType(), False),
    T.StructField("signup_date", T.DateType(), False),
    T.StructField("country", T.StringType(), False),
    T.StructField("industry", T.StringType(), False),
    T.StructField("company_size", T.StringType(), False),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("plan_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("event_date", T.DateType(), False),
    T.StructField("monthly_amount", MONEY, False),
])

# Primary keys, foreign keys and NOT NULL columns as declared for the inputs.
KEYS = {"plans": "plan_id", "customers": "customer_id", "events": "event_id"}
NOT_NULL = {
    name: [f.name for f in schema.fields if not f.nullable]
    for name, schema in (("plans", PLANS), ("customers", CUSTOMERS), ("events", EVENTS))
}

CUSTOMER_ATTRIBUTES = ["customer_name", "country", "industry", "company_size", "signup_date"]

MOVEMENT_COLUMNS = [
    "customer_id", "customer_name", "country", "industry", "company_size", "signup_date",
    "month_date", "prev_mrr", "current_mrr", "mrr_change", "mrr_category",
    "prev_plan_id", "prev_plan_name", "current_plan_id", "current_plan_name",
]
