"""Declared table schemas (the DDL of the original jobs) as StructTypes."""

from pyspark.sql import types as T

S, L, I, D, TS = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# J3: phone call facts and the contact fact table with every declared column
PHONE_CALL = _schema(
    ("call_id", L), ("phone_from", S), ("phone_to", S), ("call_start", TS), ("created", TS), ("duration", I)
)
FACT_CONTACTS = _schema(
    ("phone_1", S),
    ("phone_2", S),
    ("initial_item_id", I),
    ("main_item_id", I),
    ("last_item_id", I),
    ("cas_id", I),
    ("partner_id", I),
    ("agent_id", I),
    ("created_date", I),
    ("created_datetime", TS),
    ("first_call_start", I),
    ("first_call_start_datetime", TS),
    ("finish_date", I),
    ("finish_date_datetime", TS),
    ("contact_stage_id", I),
    ("contact_result_id", I),
    ("is_finished", I),
    ("is_succeeded", I),
    ("is_declined", I),
    ("is_unreachable", I),
    ("Contact_Total_Duration", I),
    ("First_Call_Waiting", I),
    ("Unreachable_Calls_cnt", I),
    ("Total_Calls_cnt", I),
    ("First_Call_Response", I),
    ("First_Call_Success", I),
)
CALL_UPSERT = _schema(
    ("phone_from", S), ("phone_to", S), ("Total_Calls_cnt", L), ("finish_date_datetime", TS), ("load_dttm", TS)
)
# J2 clicks
CLICKS = _schema(
    ("prospect_id", L),
    ("event_id", L),
    ("event_timestamp", L),
    ("registration_date", TS),
    ("channel_coeff", I),
    ("value", D),
)
# J4 sample table
ORDERS_SAMPLE = T.StructType([T.StructField("customer_id", I, False), T.StructField("order_id", I, False)])
# J1 event export and master
EVENT_PARAM = T.StructType([T.StructField("key", S), T.StructField("value", S)])
IDENTITY_EVENTS = _schema(
    ("event_date", T.DateType()),
    ("event_timestamp", L),
    ("event_name", S),
    ("user_id", S),
    ("user_pseudo_id", S),
    ("fingerprint", S),
    ("event_params", T.ArrayType(EVENT_PARAM)),
)
# J5 / J6 / J8 / J9 inputs
CLASSIFIER = _schema(("y_true", I), ("y_pred1", I), ("y_pred2", I))
SCORES = _schema(("doc_id", L), ("predict", D), ("target", I))
USERS = _schema(("user_id", L), ("orders", L), ("revenue", D))
CAMPAIGNS = _schema(
    ("pos", L), ("source", S), ("medium", S), ("campaign", S), ("ad_group_id", S), ("ad_id", S)
)
