"""Golden rows from FIXTURES.md and invariants per job."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import attribution, contacts, evaluation, pages, reshape


# ---------------------------------------------------------------- J2
def _clicks(spark):
    day = lambda d: int(dt.datetime(2024, 1, d, 12).replace(tzinfo=dt.timezone.utc).timestamp())
    reg = dt.datetime(2024, 1, 11)
    data = [
        ("p1", 1, day(1), reg, 0, 120.0),
        ("p1", 2, day(9), reg, 2, 120.0),
        ("p2", 3, day(11), reg, 1, 10.0),
        ("p3", 4, day(5), reg, 7, 50.0),
    ]
    return spark.createDataFrame(
        data,
        "prospect_id string, event_id long, event_timestamp long, registration_date timestamp_ntz, "
        "channel_coeff int, value double",
    )


def test_time_decay_golden(spark):
    out = {r["event_id"]: r for r in attribution.time_decay(_clicks(spark)).collect()}
    assert out[1]["date_difference_click_reg"] == 10 and out[2]["date_difference_click_reg"] == 2
    assert out[1]["weight_of_click"] == 2 and out[2]["weight_of_click"] == 10
    assert math.isclose(out[1]["time_coef_click"], 1 / 6) and math.isclose(out[2]["time_coef_click"], 5 / 6)
    assert math.isclose(out[1]["channel_coef_click"], 0.25) and math.isclose(out[2]["channel_coef_click"], 0.75)
    assert math.isclose(out[1]["value_click"], 25.0) and math.isclose(out[2]["value_click"], 95.0)
    assert math.isclose(out[3]["value_click"], 10.0)  # lone same-day click
    assert out[4]["value_click"] is None  # unknown channel


def test_time_decay_credit_sums_to_value(spark):
    from tests.conftest import SF01
    from tidemark.plans import inputs

    out = attribution.time_decay(inputs.clicks(spark, SF01))
    per = out.groupBy("prospect_id").agg(F.sum("value_click").alias("s"), F.first("value").alias("v")).collect()
    assert per and all(math.isclose(r["s"], r["v"], rel_tol=1e-9) for r in per)


def test_time_decay_plan_has_no_window(spark):
    plan = attribution.time_decay(_clicks(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


# ---------------------------------------------------------------- J3
def _calls(spark):
    t = lambda d, h=10: dt.datetime(2024, 1, d, h)
    data = [
        (1, "A", "B", t(1), 61),
        (2, "A", "C", t(1), 10),
        (3, "C", "A", t(2), 10),
        (4, "A", "D", t(3), 30),
        (5, "A", "E", t(19), 70),
        (6, "A", "F", t(4), 60),
        (7, "A", "G", t(4), 20),
    ]
    df = spark.createDataFrame(data, "call_id long, phone_from string, phone_to string, call_start timestamp_ntz, duration int")
    return df.withColumn("created", F.col("call_start"))


def test_contact_facts_golden(spark):
    facts = {(r["phone_1"], r["phone_2"]): r for r in contacts.contact_facts(_calls(spark), dt.datetime(2024, 1, 20)).collect()}
    ab = facts[("A", "B")]
    assert (ab["is_succeeded"], ab["First_Call_Response"], ab["First_Call_Success"], ab["contact_result_id"]) == (1, 1, 1, 1)
    ac = facts[("A", "C")]
    assert (ac["is_unreachable"], ac["Unreachable_Calls_cnt"], ac["Total_Calls_cnt"], ac["contact_result_id"]) == (1, 2, 2, 3)
    ad = facts[("A", "D")]
    assert (ad["is_declined"], ad["contact_result_id"], ad["First_Call_Response"]) == (1, 2, 1)
    ae = facts[("A", "E")]
    assert (ae["contact_stage_id"], ae["is_finished"], ae["is_succeeded"], ae["Total_Calls_cnt"]) == (2, 0, 0, None)
    assert facts[("A", "F")]["is_succeeded"] == 0  # exactly 60 s is not a success
    assert facts[("A", "G")]["is_unreachable"] == 1  # exactly 20 s is unreachable
    for r in facts.values():
        flags = r["is_succeeded"] + r["is_declined"] + r["is_unreachable"]
        assert flags == (1 if r["is_finished"] else 0)


def test_contact_calls_one_or_two_rows(spark):
    out = contacts.contact_calls(_calls(spark), dt.datetime(2024, 1, 20))
    assert out.count() >= 6
    assert out.groupBy("phone1", "phone2").count().filter("count > 2").count() == 0


def test_upsert(spark):
    schema = "phone_from string, phone_to string, Total_Calls_cnt long, finish_date_datetime timestamp_ntz, load_dttm timestamp_ntz"
    t0, t1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    target = spark.createDataFrame([("A", "B", 1, t0, t0), ("A", "C", 2, t0, t0)], schema)
    staging = spark.createDataFrame([("A", "B", 5, t1, t1), ("A", "B", 5, t1, t1), ("X", "Y", 3, t1, t1)], schema)
    now = dt.datetime(2024, 1, 3)
    out = contacts.upsert(target, staging, ["phone_from", "phone_to"], ["Total_Calls_cnt", "finish_date_datetime"], "load_dttm", now)
    got = {(r[0], r[1]): tuple(r)[2:] for r in out.collect()}
    assert got == {("A", "B"): (5, t1, now), ("A", "C"): (2, t0, t0), ("X", "Y"): (3, t1, t1)}
    again = contacts.upsert(out, staging, ["phone_from", "phone_to"], ["Total_Calls_cnt", "finish_date_datetime"], "load_dttm", now)
    # idempotent except for the load timestamp of re-matched rows
    assert sorted(tuple(r)[:4] for r in again.collect()) == sorted(tuple(r)[:4] for r in out.collect())
    bad = spark.createDataFrame([("A", "B", 5, t1, t1), ("A", "B", 6, t1, t1)], schema)
    with pytest.raises(Exception, match="several staging rows"):
        contacts.upsert(target, bad, ["phone_from", "phone_to"], ["Total_Calls_cnt"], "load_dttm", now).collect()


# ---------------------------------------------------------------- J5 / J6 / J8
def test_model_metrics_golden(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, 0), (1, 1, 0, 0), (1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 0, 0)], "y int, p1 int, p2 int, p3 int"
    )
    m = {r["model"]: r for r in evaluation.model_metrics(df, "y", ["p1", "p2", "p3"]).collect()}
    assert (m["p1"]["tn"], m["p1"]["fp"], m["p1"]["fn"], m["p1"]["tp"]) == (1, 1, 1, 2)
    assert math.isclose(m["p1"]["precision"], 2 / 3) and math.isclose(m["p1"]["f1"], 2 / 3)
    assert (m["p2"]["tn"], m["p2"]["fp"], m["p2"]["fn"], m["p2"]["tp"]) == (2, 0, 2, 1)
    assert math.isclose(m["p2"]["recall"], 1 / 3) and math.isclose(m["p2"]["f1"], 0.5)
    assert m["p3"]["precision"] == 0.0 and m["p3"]["f1"] == 0.0  # never predicts 1
    verdict = evaluation.model_compare(evaluation.model_metrics(df, "y", ["p1", "p2"]), "p1", "p2").first()
    assert verdict["verdict"] == "First test better than second"


@pytest.mark.parametrize(
    "n,sizes",
    [
        (10, [2, 2, 2, 2, 2]),
        (100, [11] * 9 + [1]),
        (399, [41, 41, 41, 41, 41, 40, 41, 41, 41, 31]),
        (1000, [101] * 9 + [91]),
    ],
)
def test_recall_bucket_sizes(spark, n, sizes):
    df = spark.createDataFrame([(i, float(i % 37), i % 2) for i in range(n)], "doc_id long, predict double, target int")
    out = evaluation.recall_by_bucket(df, "predict", "target", "doc_id").orderBy("quantile").collect()
    assert [r["total"] for r in out] == sizes
    assert out[-1]["recall"] == 100.0
    assert [r["recall"] for r in out] == sorted(r["recall"] for r in out)
    assert sum(r["total"] for r in out) == n


def test_product_metrics_golden(spark):
    orders = [5, 0, 2, 3, 4, 2, 3, 1, 0, 0]
    revenue = [15000, 0, 4000, 4000, 7000, 1500, 2500, 1000, 0, 0]
    df = spark.createDataFrame([(i, o, float(r)) for i, (o, r) in enumerate(zip(orders, revenue))], "user_id int, orders int, revenue double")
    r = evaluation.product_metrics(df).first()
    assert (r["aov"], r["arpu"], r["arppu"], r["paying_share"]) == (1750.0, 3500.0, 5000.0, 0.7)
    assert math.isclose(r["arpu"], r["arppu"] * r["paying_share"])


# ---------------------------------------------------------------- J9 / J10 / J12 / J14
def test_campaign_slice_golden(spark):
    data = [
        (1, "google", "cpc", "111", "3333", "3333_4545_keyword_1"),
        (2, "google", "cpc", "222", "4444", "4444_6666_keyword_2"),
        (3, "facebook", "cpa", "233", "5656", "test_ads_facebook"),
        (4, "youtube", "cpc", "aaa", "3434", "blogger_a_channel_b"),
    ]
    df = spark.createDataFrame(data, "pos int, source string, medium string, campaign string, ad_group_id string, ad_id string")
    out = reshape.campaign_slice(df, "medium", "cpc").orderBy("pos").collect()
    assert [r["source"] for r in out] == ["google", "google", "youtube"]
    assert [r["ad_id"] for r in out] == ["3333_4545_keyword_1", "4444_6666_keyword_2", "blogger_a_channel_b"]
    assert reshape.campaign_slice(df, "medium", "cpc", depth=2).columns == ["pos", "source", "medium"]


def test_melt_drops_nulls(spark):
    df = spark.createDataFrame([(1, "x", None), (None, "y", 2.5)], "a int, b string, c double")
    out = reshape.melt_name_value(df)
    assert sorted(map(tuple, out.collect())) == [("a", "1"), ("b", "x"), ("b", "y"), ("c", "2.5")]


def test_event_payload_json(spark):
    df = spark.createDataFrame([("c1", "view", 3)], "client_id string, param_name_1 string, param_name_2 long")
    p = reshape.event_payloads(df, "purchase").first()["payload"]
    assert p == (
        '{"client_id":"c1","events":[{"name":"purchase","params":'
        '{"event_param_name_1":"view","event_param_name_2":3}}]}'
    )


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string")
    out = {r["column_name"]: r for r in reshape.profile(df).collect()}
    assert (out["a"]["data_type"], out["a"]["non_null_count"], out["a"]["null_count"]) == ("bigint", 2, 0)
    assert (out["b"]["data_type"], out["b"]["non_null_count"], out["b"]["null_count"]) == ("string", 1, 1)


# ---------------------------------------------------------------- J13
def test_page_elements_skip_script_and_comments(spark):
    html = (
        '<html><head><script>var s="<a href=\\"/no\\">x</a>";</script></head><body>'
        '<!-- <h1>hidden</h1> --><a class="n" href="/one">1</a><h1>Tom &amp; Jerry</h1>'
        '<div class="ad">Buy &lt;now&gt;</div><a href="/two">2</a></body></html>'
    )
    df = spark.createDataFrame([(7, "u", html)], "page_id long, url string, html string")
    out = sorted(map(tuple, pages.page_elements(df).collect()))
    assert out == [
        (7, "a_href", 0, "/one"),
        (7, "a_href", 1, "/two"),
        (7, "div_ad", 0, "Buy <now>"),
        (7, "h1", 0, "Tom & Jerry"),
    ]


def test_normalise_and_ngrams(spark):
    from tidemark.functions.text import characters, normalise, spaced, substrings
    from tidemark.operators import text

    df = spark.createDataFrame([(1, "Ab, c!"), (2, "")], "id long, t string")
    assert df.select(normalise(F.col("t"))).first()[0] == "ab  c "
    assert df.select(spaced(F.lit("abc"))).first()[0] == "a b c"
    grams = df.filter("id = 1").select(substrings(characters(F.col("t")), 1, 2)).first()[0]
    assert grams[:6] == ["A", "b", ",", " ", "c", "!"] and grams[6:] == ["Ab", "b,", ", ", " c", "c!"]
    # brute force: whole-text character n-gram counts as the reference analyzer builds them
    docs = spark.createDataFrame([(1, 0, "abab a"), (2, 0, "bb"), (3, 0, "")], "conv_id long, turn long, text string")
    got = {(r["conv_id"], r["term"]): r["term_count"] for r in text.restricted_counts(docs, ["conv_id", "turn"], "text", 1000)[0].collect()}
    want = {}
    for cid, _, t in docs.collect():
        chars = list(t)
        for n in range(1, 5):
            for i in range(len(chars) - n + 1):
                key = (cid, " ".join(chars[i : i + n]))
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_kmeans_fit_then_assign_new_lines(spark):
    from tidemark.operators import text

    rows = [(i, 0, ("comment " + str(i % 3)) if i % 2 else "zzz yyy xxx " * 3) for i in range(40)]
    docs = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    fitted = text.fit_comment_clusters(docs, ["conv_id", "turn"], "text", max_features=50)
    new = spark.createDataFrame([(1, 0, "comment 1"), (2, 0, "comment 2"), (3, 0, "zzz yyy xxx " * 3)], "conv_id long, turn long, text string")
    got = {r["conv_id"]: r["cluster"] for r in fitted.assign(new, ["conv_id", "turn"], "text").collect()}
    assert got[1] == got[2] != got[3]


PAGES = "page_id long, url string, html string"


def _elements(spark, html, elements=None):
    df = spark.createDataFrame([(1, "u", html)], PAGES)
    return sorted(tuple(r)[1:] for r in pages.page_elements(df, elements).collect())


def test_page_elements_nesting_case_and_quotes(spark):
    html = (
        "<html><body><div class='x ad'>outer <div>inner</div> tail</div>"
        '<a title="t" href="/q?a=1&amp;b=2">x</a><h1>A <b>bold</b> title</h1>'
        "<script>var s='<h1>no</h1>';</script></body></html>"
    )
    assert _elements(spark, html) == [("a_href", 0, "/q?a=1&b=2"), ("div_ad", 0, "outer inner tail"), ("h1", 0, "A bold title")]
    # nested matches in document order; an element never closed runs to the end
    odd = "<div class=ad>a<div class='ad'>b</div></div><P><IMG src=x>t</P><h1>open <br>only"
    both = {"h1": pages.Element("h1"), "head": pages.Element("H1"), "div_ad": pages.Element("div", "ad")}
    assert _elements(spark, odd, both) == [("div_ad", 0, "ab"), ("div_ad", 1, "b"), ("h1", 0, "open only"), ("head", 0, "open only")]
    mixed = (
        "<A\nHREF = '/one' >1</A><a title='href=\"/no\"' Href=/two>2</a><a href>3</a><a name=x>4</a><!-- <h1>c</h1> -->"
        '<DIV id="d" CLASS="big  ad\tx">x > y</Div><div class="adx">no</div><h1 title="a > b">one</h1></b><p>1 < 2'
        "<section><h1>two<p>para</section>after<h1/><STYLE>h1{}</STYLE><script>'<h1>never</h1>'"
    )
    assert _elements(spark, mixed) == [
        ("a_href", 0, "/one"), ("a_href", 1, "/two"), ("a_href", 2, ""),
        ("div_ad", 0, "x > y"), ("h1", 0, "one"), ("h1", 1, "twopara"), ("h1", 2, ""),
    ]
    for nothing in (None, "", "plain", "<", "<h1", "</h1>", "<!-- <h1>x</h1>"):
        assert _elements(spark, nothing) == []


def test_page_elements_stay_on_the_jvm(spark):
    df = spark.createDataFrame([(1, "u", "<h1>x</h1>")], PAGES)
    plan = pages.page_elements(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
