"""Operators against brute force on small hand-made frames."""

import datetime as dt
import itertools
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from surelake.operators import alerts, base, channel, claim, enterprise, facts, graph, headcount, matching, members, merge, overlap, person, premium, profile, recon, web
from surelake.operators import models as M


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# ------------------------------------------------------------------- labels


@pytest.mark.parametrize(
    "months,length",
    [(["201802", "201803", "201806", "201808", "201809", "201810"], 3), (["201611"], 1), ([None], 0),
     (["201911", "201912", "202001", "202001"], 3), (["201901", "201903"], 1)],
)
def test_streak(spark, months, length):
    df = frame(spark, "ent_id string, month_id string", *[("e", m) for m in months])
    assert enterprise.streak_lengths(df, "ent_id").first()["streak"] == length


def test_ties_are_broken_by_name(spark):
    policy = frame(spark, "policy_id int, ent_id string", (1, "e"))
    insured = frame(spark, "policy_id int, insured_work_type string, insure_policy_status string", (1, "b", "1"), (1, "a", "1"), (1, "c", "2"))
    level = frame(spark, "work_type string, ai_level int", ("a", 1), ("b", 2), ("c", 3))
    assert rows(enterprise.job_type_nth(policy, insured, level, 1)) == [("e", "a|1")]
    assert rows(enterprise.job_type_nth(policy, insured, level, 2)) == [("e", "b|1")]
    assert rows(enterprise.job_type_nth(policy, insured, level, 3)) == []


def test_potential_headcount_is_compared_as_numbers(spark):
    policy = frame(spark, "policy_id int, ent_id string, policy_status string", (1, "e", "1"))
    insured = frame(spark, "policy_id int, insured_cert_no string, insure_policy_status string", (1, "1" * 18, "1"))
    size = frame(spark, "ent_id string, ent_scale string", ("e", "9"), ("e", "100"))
    assert rows(enterprise.potential_headcount(policy, insured, size)) == [("e", 99)]


CLAIM = "policy_no string, id string, case_type string, disable_level string, scene string, status string, overtime string, if_resubmit_paper string, risk_date string, report_date string, paper_finish_date string, finish_days string, pre_com string, final_payment string"


def a_claim(**kw):
    base_ = dict(policy_no="P", id="1", case_type="受伤", disable_level="无", scene="工作期间", status="x", overtime="否", if_resubmit_paper="否",
                 risk_date="2020/1/1", report_date="2020/1/1", paper_finish_date=None, finish_days="5", pre_com="10", final_payment="")
    return tuple({**base_, **kw}.values())


def test_labels_of_empty_groups_are_absent(spark):
    policy = frame(spark, "policy_code string, ent_id string", ("P", "e"), ("Q", "f"))
    claims = frame(spark, CLAIM, a_claim(), a_claim(id="2", if_resubmit_paper="是", case_type="死亡"), a_claim(policy_no="Q", id="3"))
    assert rows(claim.label(claims, policy, "ent_material_integrity")) == [("e", 0.5)]
    assert rows(claim.label(claims, policy, "largecase_rate")) == []
    assert rows(claim.label(claims, policy, "death_num")) == [("e", 1)]
    assert len(rows(claim.label(claims, policy, "death_num", keep_empty=True))) == 2


def test_delay_is_at_least_one_day_and_needs_strict_dates(spark):
    policy = frame(spark, "policy_code string, ent_id string", ("P", "e"))
    claims = frame(spark, CLAIM, a_claim(), a_claim(id="2", report_date="2020/1/4"), a_claim(id="3", report_date="2020/13/4"), a_claim(id="4", report_date="未知"))
    assert rows(claim.label(claims, policy, "ent_report_time")) == [("e", 2.0)]


def test_total_payout_skips_rows_without_expected_amount(spark):
    policy = frame(spark, "policy_code string, ent_id string", ("P", "e"))
    claims = frame(spark, CLAIM, a_claim(final_payment="7"), a_claim(pre_com="#N/A", final_payment="5"), a_claim(pre_com=None, final_payment="3"))
    assert rows(claim.label(claims, policy, "pre_all_compensation")) == [("e", 7.0)]
    assert rows(claim.label(claims, policy, "pre_wt_compensation")) == [("e", 15.0)]


def test_settle_days_text(spark):
    policy = frame(spark, "policy_code string, ent_id string", ("P", "e"))
    claims = frame(spark, CLAIM, *[a_claim(id=str(i), finish_days=t) for i, t in enumerate(["6", "=未结", "=3", "", "1234567890"])])
    assert rows(claim.label(claims, policy, "avg_aging_cps")) == [("e", 3.0)]


def test_person_payout_average_divisor_counts_dirty_rows(spark):
    c = frame(spark, "cert_no string, pre_com string, final_payment string, time_effect string",
              ("abc", "10", "5", "2"), ("abc", "#N/A", "", "(43304)"), ("abc", "未知", None, None))
    assert rows(person.person_payout_avg(c)) == [("abc", 5.0, 1.67, 2.0)]


def test_exact_label_match_in_channel_roll_up(spark):
    wide = frame(spark, "ent_id string, ent_city double, ent_city_type double", ("a", 1.0, 5.0), ("b", 2.0, 7.0))
    chan = frame(spark, "ent_id string, channel string", ("a", "c"), ("b", "c"))
    out = channel.roll_sum(channel.triples(wide, "ent_id", "baseinfo"), chan)
    assert rows(out) == [("c", "ent_city", 3.0), ("c", "ent_city_type", 12.0)]


def test_direct_customers_are_their_own_channel(spark):
    s = frame(spark, "ent_id string, ent_name string, channel_name string", ("1", " A ", "直客"), ("2", "B", "X"))
    assert rows(channel.channel_map(s)) == [("1", "A", "A"), ("2", "B", "X")]


# ------------------------------------------------------- premium, headcount


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def random_spans(rng, policies=4, people=5, n=60):
    return [(rng.randrange(policies), f"i{i}", f"c{rng.randrange(people)}", day(s := rng.randrange(40)), day(s + rng.randrange(-2, 12))) for i in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_daily_headcount_brute_force(spark, seed):
    rng = random.Random(seed)
    spans = random_spans(rng)
    pol = [(p, f"P{p}", f"e{p % 2}", "1", day(a := rng.randrange(20)), day(a + rng.randrange(1, 30))) for p in range(5)]
    policy = frame(spark, "policy_id int, policy_code string, ent_id string, insure_code string, start_date date, end_date date", *pol)
    insured = frame(spark, "policy_id int, insured_id string, insured_cert_no string, insured_start_date date, insured_end_date date", *spans)
    want = {}
    for p, code, _, _, s, e in pol:
        for k in range((e - s).days + 1):
            d = s + dt.timedelta(days=k)
            want[(p, f"{d:%Y%m%d}")] = len({c for q, _, c, a, b in spans if q == p and a <= d <= b})
    got = {(r.policy_id, r.day_id): r.curr_insured for r in headcount.daily_headcount(policy, insured).collect()}
    assert got == want
    cut = headcount.daily_headcount(policy, insured, since=day(10).isoformat(), until=day(15).isoformat())
    assert {(r.policy_id, r.day_id): r.curr_insured for r in cut.collect()} == {k: v for k, v in want.items() if "20200111" <= k[1] <= "20200116"}
    snap = headcount.headcount_on(policy, insured, day(12).isoformat())
    assert {(r.policy_id, r.day_id): r.curr_insured for r in snap.collect()} == {k: v for k, v in want.items() if k[1] == "20200113"}
    by_ent = headcount.headcount_ent_day(policy, headcount.daily_headcount(policy, insured))
    carried = headcount.daily_headcount_by_ent(policy, insured)
    assert rows(by_ent) == rows(carried)


@pytest.mark.parametrize("seed", range(3))
def test_policy_standing_equals_its_parts(spark, seed):
    from surelake.operators import standing

    rng = random.Random(seed)
    pol = [(p, None if p == 4 else f"P{p}", f"e{p % 2}", "19"[p == 3], str(1 + p % 3), None if p == 2 else 100.0 + p, "01"[p % 2], day(a := rng.randrange(20)), day(a + rng.randrange(1, 30)))
           for p in range(6)]
    policy = frame(spark, "policy_id int, policy_code string, ent_id string, insure_code string, sku_charge_type string, sku_price double, policy_status string, "
                   "start_date date, end_date date", *pol)
    spans = [*random_spans(rng), (0, "n", None, day(3), day(9)), (0, "m", None, day(1), day(20)), (1, "w", "x ", day(2), day(40)), (1, "v", "x", day(2), day(40)),
             (1, "u", "u", day(9), day(2))]
    insured = frame(spark, "policy_id int, insured_id string, insured_cert_no string, insured_start_date date, insured_end_date date", *spans)
    tidy = insured.withColumn("insured_cert_no", F.trim("insured_cert_no"))
    scope = frame(spark, "product_code string", ("1",), ("1",))
    now = day(12).isoformat()
    got = standing.policy_standing(policy, insured, now, scope)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(policy_id") == 2, plan  # one for the policies, one for the person rows
    assert rows(got.where("running").select("policy_id", "day_id", "curr_insured")) == rows(
        headcount.headcount_on(policy, tidy, now, scope).select("policy_id", "day_id", "curr_insured"))
    assert rows(got.where("charged_premium IS NOT NULL").select("policy_id", "charged_premium")) == rows(
        premium.premium_to_date(policy, insured, now, scope).select("policy_id", "charged_premium"))
    persons = {r.policy_id: r.persons for r in got.collect()}
    assert persons == {p: len({(c or "").strip() for q, _, c, *_ in spans if q == p}) for p, _, _, code, *_ in pol if code == "1"}
    assert got.select("policy_id").distinct().count() == got.count()


def test_member_sums(spark):
    policy = frame(spark, "policy_id int, policy_code string, insure_code string, policy_status string, holder_company string, premium double, effect_date date",
                   (1, "P1", "1", "1", " A ", 5.0, day(0)), (2, "P2", "9", "1", "A", 7.0, day(0)), (3, "P3", "9", "0", "B", 11.0, day(40)), (4, "P4", "1", "3", "B", 1.0, day(0)))
    columns = "policy_id int, running boolean, curr_insured bigint, charged_premium decimal(24,4)"
    standing = frame(spark, columns, (1, True, 3, Decimal("2.5")), (2, False, 8, None), (4, True, 9, Decimal("9")))
    claims = frame(spark, CLAIM, *[a_claim(policy_no=p, pre_com=c) for p, c in (("P1", "10"), ("P1", "#N/A"), ("P2", "4"), ("P4", "100"))])
    channel = frame(spark, "ent_id string, ent_name string", ("a", "A"), ("a", "A "), ("b", "B"), ("c", "C"), ("d", None))
    product = frame(spark, "product_code string, dim_1 string", ("1", "骑士保"), ("9", "零工保"), ("9", "零工保"))
    got = {r.ent_id: (float(r.due), float(r.earned), r.persons) for r in members.member_sums(policy, claims, standing, channel, product, day(12).isoformat()).collect()}
    assert got == {"a": (14.0, 9.5, 3), "b": (0.0, 0.0, 0), "c": (0.0, 0.0, 0), "d": (0.0, 0.0, 0)}


@pytest.mark.parametrize("seed", range(2))
def test_premium_steps_equal_day_expansion(spark, seed):
    rng = random.Random(seed)
    policy = frame(spark, "policy_id int, ent_id string, policy_status string, insure_code string, sku_charge_type string, sku_price double, start_date date, end_date date",
                   *[(p, f"e{p % 2}", "1", "1", str(1 + p % 2), 100.0 + p, day(0), day(29)) for p in range(4)])
    insured = frame(spark, "policy_id int, insured_id string, insured_cert_no string, insured_start_date date, insured_end_date date", *random_spans(rng))
    daily = premium.premium_daily(policy, insured)
    want = rows(daily.groupBy("policy_id", "day_id").agg(F.sum("sku_day_price").cast("decimal(20,4)")))
    assert rows(premium.premium_policy_day(policy, insured)) == want
    to = rows(daily.where("day_id <= '20200115'").groupBy("policy_id", "ent_id").agg(F.sum("sku_day_price").cast("decimal(24,4)")))
    assert rows(premium.premium_to_date(policy, insured, "2020-01-15")) == to
    months = rows(daily.groupBy("ent_id", F.substring("day_id", 1, 6)).agg(F.sum("sku_day_price").cast("decimal(24,4)")))
    assert rows(premium.premium_ent_month(policy, insured)) == months


def test_growth(spark):
    m = frame(spark, "ent_id string, month_id string, premium int", *[("e", f"20190{i}", v) for i, v in ((1, 100), (2, 200), (3, 400), (9, 1))], ("one", "201901", 5))
    m = m.withColumn("premium", F.col("premium").cast("decimal(24,4)"))
    got = {r.ent_id: (r.slope, r.three_slope) for r in premium.premium_slope(m, "2019-05-01").collect()}
    assert got == {"e": (100.0, 100.0), "one": (0.0, 0.0)}


def test_first_premium_subtracts_additions_and_returns_removals(spark):
    policy = frame(spark, "policy_id int, premium double", (1, 100.0), (2, 50.0))
    ch = frame(spark, "policy_id int, add_premium double, del_premium double", (1, 30.0, None), (1, None, 10.0))
    assert rows(premium.first_premium(policy, ch)) == [(1, 80.0), (2, 50.0)]


# ------------------------------------------------------------ tiers, alerts


def tier(spark, months, people, due=80.0, earned=100.0):
    chan = frame(spark, "ent_id string, channel string", ("e", "c"))
    money = frame(spark, "ent_id string, due double, earned double", ("e", due, earned))
    mon = frame(spark, "ent_id string, month_id string", *[("e", m) for m in months])
    ppl = frame(spark, "ent_id string, month_id string, persons bigint", *[("e", m, p) for m, p in people])
    out = members.member_tier(chan, money, mon, ppl, "2020-06-15").collect()
    return [(r.tier, r.downgrade, r.real_tier) for r in out]


HALF_YEAR = [f"20200{i}" for i in range(1, 7)]
NINE = ["201910", "201911", "201912", *HALF_YEAR]


def test_member_tiers(spark):
    assert tier(spark, HALF_YEAR, [(m, 9000) for m in HALF_YEAR]) == [("diamonds", 1, "gold")]
    assert tier(spark, NINE, [(m, 30000) for m in NINE], due=50.0) == [("partner", 0, "partner")]
    assert tier(spark, NINE, [(m, 100) for m in NINE[:-1]] + [("202006", 30000)]) == [("partner", 3, "silver")]
    assert tier(spark, ["202006"], [("202006", 8000)]) == [("diamonds", 3, "ordinary")]
    assert tier(spark, ["202006"], [("202006", 3000)], due=74.0) == [("gold", 0, "gold")]
    assert tier(spark, ["202006"], [("202006", 1000)], due=100.0) == [("silver", 2, "ordinary")]
    assert tier(spark, ["202006"], [("202006", 1)]) == [("ordinary", 0, "ordinary")]
    assert tier(spark, ["202005"], [("202006", 5000)]) == []  # the streak must reach the current month
    assert tier(spark, ["202006"], [("202006", 0)]) == []


def test_alert_levels(spark):
    ch = frame(spark, "name string, yesterday bigint, today bigint, peak bigint, diff bigint, ratio double",
               ("up1", 1000, 1200, 1300, 200, 0.2), ("up2", 300, 500, 500, 200, 0.67), ("no", 5000, 5200, 5200, 200, 0.04), ("down3", 400, 5, 400, -395, -0.98),
               ("down2", 1000, 400, 500, -600, -0.6), ("gone", 0, 0, 10, 0, 0.0))

    def levels(df):
        return {r.name: r.l for r in df.select("name", F.get_json_object("payload", "$.level").alias("l")).collect()}

    assert levels(alerts.surge(ch, "2020-01-02")) == {"up1": "一级", "up2": "二级"}
    assert levels(alerts.drop(ch, "2020-01-02")) == {"down3": "三级", "down2": "二级"}
    assert levels(alerts.headcount_fall(ch, "2020-01-02")) == {"down3": "三级", "gone": "三级"}
    history = frame(spark, "name string, total_premium double, total_persons bigint, first_day string, last_day string", ("gone", 9.0, 3, "20190101", "20190201"))
    lost = alerts.lost(ch, history, "2020-01-02")
    assert [r.name for r in lost.collect()] == ["gone"]
    assert lost.select(F.get_json_object("payload", "$.lmhInsuredPersonsMax")).first()[0] == "10"  # the peak, not the ratio
    line = alerts.as_lines(lost).first()["value"].split(";")
    assert line[1:5] == ["LOSS", "gone", "20200102", ""] and len(line[0]) == 32


def test_ratio_is_zero_when_nobody_was_insured_yesterday(spark):
    e = frame(spark, "ent_name string, yesterday_insured_persons bigint, cur_insured_persons bigint, lastmonth_insured_persons_max bigint", ("a", 0, 500, 0))
    assert alerts.changes(e).first()["ratio"] == 0.0


# ------------------------------------------------------------------- merges


def test_rows_in_both_branches_appear_twice(spark):
    person_ = frame(spark, "id string, policy_id string, name string, work_type string, cert_no string, remark string, start_date string",
                    ("1", "p", "张\n三x", "工", "1101011990051012\n34", None, "2020-05-10"), ("2", "p", "a", None, "1", "obsolete", None), ("3", "q", "a", None, "1", None, None))
    child = frame(spark, "id string, insured_id string", ("c1", "1"), ("c2", "1"))
    policy = frame(spark, "id string, user_id string, insure_code string, policy_code string",
                   ("p", "7", "15000001", "PRE1"), ("q", "9999", "1", "PRE2"))
    out = merge.insured_v1(person_, child, policy, merge.SourceRules(("9999",), "15000001", "PRE"))
    assert Counter(r.insured_id for r in out.collect()) == {"1": 4, "2": 1}
    first = out.where("insured_id = '1'").first()
    assert (first.insured_name, first.insured_cert_no, first.age) == ("张三", "110101199005101234", 31)


def test_remove_only_orders_end_a_day_later(spark):
    orders = frame(spark, "preserve_id int, add_person_count int, del_person_count int", (1, 0, 2), (2, 1, 1), (3, 1, 0))
    persons = frame(spark, "preserve_id int, join_date date, left_date date, remark string",
                    (1, None, dt.date(2019, 1, 1), None), (1, None, dt.date(2019, 1, 5), "x"), (2, dt.date(2019, 9, 30), None, "x"),
                    (2, dt.date(2019, 10, 1), dt.date(2019, 12, 1), None), (3, dt.date(2018, 1, 1), None, "obsolete"))
    assert rows(merge.endorse_dates(orders, persons).where("preserve_id < 3")) == [
        (1, None, dt.date(2019, 1, 2)), (2, dt.date(2019, 10, 1), dt.date(2019, 9, 30))]
    assert merge.endorse_dates(orders, persons).where("preserve_id = 3").first()["pre_start_date"] is None


def test_reconciliation(spark):
    big = frame(spark, "policy_no string, batch_no string, premium double, settlement double", ("a", "1", 1.0, 1.0), ("b", "1", 2.0, 2.0))
    small = frame(spark, "policy_no string, batch_no string, premium double, settlement double", ("a", "1", 3.0, 4.0), ("a", "1", 5.0, 6.0), ("z", "9", 0.0, 0.0))
    got = rows(recon.recon_match(big, small, ["policy_no"]).select("policy_no", "small_premium", "small_settlement", "machine"))
    assert got == [("a", 8.0, 10.0, "匹配成功"), ("无", None, None, "匹配失败")]
    assert [r[0] for r in rows(recon.recon_unmatched(small, big, ["policy_no", "batch_no"]))] == ["z"]


# ------------------------------------------------------------ facts, profile


def test_mobiles_with_two_ids_give_no_flags(spark):
    f = frame(spark, "insured_name string, insured_cert_no string, insured_mobile string, product_type string",
              ("a", "1", "m", "雇主"), ("a", "1", "m", "体育"), ("b", "2", "n", "体育"), ("c", "3", "n", "体育"), ("d", None, "o", "ofo"))
    got = {r.insured_name: (r.employer, r.sport, r.ofo) for r in facts.product_flags_by_mobile(f).collect()}
    assert got == {"a": (1, 1, 0), "b": (0, 0, 0), "c": (0, 0, 0), "d": (0, 0, 1)}


def test_hour_three_is_night(spark):
    at = [dt.datetime(2020, 1, 6, 3, i) for i in range(10)] + [dt.datetime(2020, 1, 7, 8)] * 3
    rides = frame(spark, "insured_cert_no string, start_date timestamp, end_date timestamp, product_code string", *[("110101199005101234", t, t, "OFO00001") for t in at])
    r = profile.ride_behaviour(profile.ride_facts(rides, "2020-02-01"), "2020-02-01").first()
    assert (r.early_night, r.work, r.weeks, r.frequency, r.user_type, r.guarantee) == ("夜猫子", "上班族", "1", "6", "校园版", "30")
    old = profile.ride_behaviour(profile.ride_facts(rides, "2021-02-01"), "2021-02-01").first()
    assert old.frequency == "null"


def test_profile_json(spark):
    src = frame(spark, "cert string, mobile string, create_time string, end_time string, product_code string, customer_name string, identity string, insured_name string",
                ("110101199005101234", "", "2019-01-30", "2019-06-01", "官网", "s1", "", "x"), ("110101199005101234", "", "2019-02-15", "2019-07-01", "ofo", "s2", "w", "y"))
    p = profile.profile_person(src, "2019-02-28")
    doc = profile.profile_json(p).first()["user_person_none_ofo"]
    assert '"Insure_to_month":"1"' in doc and '"social_Identity":"w"' in doc and '"user_insure_product_num":"2"' in doc


def test_shift_times_by_look_of_the_value(spark):
    df = frame(spark, "a string, b string, c string, custom_var_k1 string", ("2020-01-01 20:00:00", "20:00:00", "http://x-y:1", "z"))
    assert rows(web.shift_times(df)) == [("2020-01-02 04:00:00", "04:00:00", "http://x-y:1")]


# ----------------------------------------------------------------- matching


@pytest.mark.parametrize("seed,slack,salt", [(0, 0, 50_000), (1, 1, 50_000), (2, 0, 7), (3, 1, 5)])
def test_best_overlaps_brute_force(spark, monkeypatch, seed, slack, salt):
    monkeypatch.setattr(overlap, "ROWS_PER_SALT", salt)
    rng = random.Random(seed)
    word = lambda: f"w{min(int(rng.expovariate(0.15)), 60)}"  # a few words are everywhere
    q = {i: {word() for _ in range(rng.randrange(1, 9))} | {"unknown"} for i in range(25)}
    k = {i: {word() for _ in range(rng.randrange(1, 12))} for i in range(120)}
    want = set()
    for i, a in q.items():
        shared = {j: len(a & b) for j, b in k.items()}
        top = max(shared.values())
        want |= {(i, j, n) for j, n in shared.items() if n >= max(top - slack, 1)}
    got = overlap.best_overlaps(frame(spark, "qid int, tokens array<string>", *[(i, sorted(t)) for i, t in q.items()]),
                                frame(spark, "kid int, tokens array<string>", *[(i, sorted(t)) for i, t in k.items()]), slack=slack)
    assert {(r.qid, r.kid, r.overlap) for r in got.collect()} == want


@pytest.mark.parametrize("salt", [50_000, 6])
def test_containing_brute_force(spark, monkeypatch, salt):
    monkeypatch.setattr(overlap, "ROWS_PER_SALT", salt)
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    texts = {i: text(rng.randrange(0, 14)) for i in range(60)}
    needles = {i: text(rng.randrange(1, 5)) for i in range(40)}
    want = {(i, j) for i, n in needles.items() for j, t in texts.items() if n in t}
    got = overlap.containing(frame(spark, "qid int, needle string", *needles.items()), frame(spark, "kid int, text string", *texts.items()))
    assert {tuple(r) for r in got.collect()} == want and len(got.collect()) == len(want)


def test_best_names_brute_force(spark):
    rng = random.Random(9)
    name = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
    holders, buyers = sorted({name() for _ in range(60)}), sorted({name() for _ in range(40)})

    def cos(a, b):
        x, y = Counter(a), Counter(b)
        return min(sum(x[c] * y[c] for c in x) / (sum(v * v for v in x.values()) ** 0.5 * sum(v * v for v in y.values()) ** 0.5), 1.0)

    got = matching.best_names(frame(spark, "name string", *[(b,) for b in buyers]), frame(spark, "name string", *[(h,) for h in holders]))
    got = {r["name"]: (r.holder, r.similarity) for r in got.collect()}
    for b in buyers:
        best = max(round(cos(b, h), 4) for h in holders)
        assert got[b][1] == pytest.approx(best, abs=1e-4) and cos(b, got[b][0]) == pytest.approx(best, abs=1e-4)


def test_name_similarity_edges(spark):
    inv = frame(spark, "id int, purchaser_name string", (1, ""), (2, None), (3, "zz"), (4, "ab"))
    h = frame(spark, "holder_name string", ("abc",), (" ab ",))
    assert {r.id: (r.purchaser_res, r.similarity) for r in matching.name_similarity(inv, h).collect()} == {1: ("", 1.0), 2: (None, 1.0), 3: (None, 0.0), 4: ("ab", 1.0)}
    assert [r.id for r in matching.name_similarity(inv, h, frame(spark, "id int", (1,), (2,), (3,))).collect()] == [4]


def test_long_needles_are_found_through_few_rows(spark, monkeypatch):
    from surelake.operators import overlap

    rng = random.Random(8)
    texts = {i: "".join(rng.choice("abcd é\U0001f600") for _ in range(rng.choice((3, 15, 16, 40, 64, 200)))) for i in range(80)}
    texts[80] = texts[3] + texts[5] + texts[6]
    texts[81] = texts[80]
    cuts = [(a := rng.randrange(len(t)), t[a : a + n]) for t in texts.values() for n in (1, 2, 15, 16, 17, 63, 64, 90)]
    asked = {str(n): c for n, c in enumerate(dict.fromkeys(c for _, c in cuts if c))}
    asked["none"] = "x" * 70
    traffic = []
    made = overlap.candidates
    monkeypatch.setattr(overlap, "candidates", lambda *a: (traffic.append(d := made(*a)), d)[1])
    frames = frame(spark, "qid string, needle string", *asked.items()), frame(spark, "kid int, text string", *texts.items())
    got = {tuple(r) for r in overlap.containing(*frames).collect()}
    assert got == {(q, k) for q, n in asked.items() for k, t in texts.items() if n in t}
    long = {q for q, n in asked.items() if len(n) >= 16}
    pairs = {tuple(r) for d in traffic for r in d.collect()}
    assert len({p for p in pairs if p[0] in long}) < 1.5 * len({p for p in got if p[0] in long})


@pytest.mark.parametrize("chunk", [2, 3, 256])
def test_shared_people_brute_force(spark, chunk):
    rng = random.Random(3)
    pairs = [(f"h{rng.randrange(14)}", f"p{min(int(rng.expovariate(0.3)), 20)}") for _ in range(220)]
    of = defaultdict(set)
    for h, p in pairs:
        of[h].add(p)
    want = {(a, b, len(of[a] & of[b])) for a, b in itertools.combinations(sorted(of), 2) if of[a] & of[b]}
    got = matching.shared_people(frame(spark, "holder string, person string", *pairs), chunk)
    assert {tuple(r) for r in got.collect()} == want


def test_shared_people_of_many_holders_ships_lists(spark):
    from tests.plan_audit import plan_of

    pairs = [(f"h{h:03d}", f"p{p}") for h in range(60) for p in range(30) if (h + p) % 3]
    of = defaultdict(set)
    for h, p in pairs:
        of[h].add(p)
    df = matching.shared_people(frame(spark, "holder string, person string", *pairs), 16)
    assert {tuple(r) for r in df.collect()} == {(a, b, len(of[a] & of[b])) for a, b in itertools.combinations(sorted(of), 2) if of[a] & of[b]}
    # pairs of holders are added up where they are expanded: no exchange between the two
    above = plan_of(df).split("Generate explode(y")[0]
    assert above.split("Exchange")[-1].count("HashAggregate") == 2


def test_shared_people_never_shuffles_pairs(spark, monkeypatch):
    from tests.plan_audit import plan_of

    # several blocks, and several tasks for every two of them
    monkeypatch.setattr(matching, "PAIRS_PER_TASK", 20)
    monkeypatch.setattr(matching, "MOST_ROUNDS", 3)
    rng = random.Random(5)
    pairs = [(f"h{min(int(rng.expovariate(0.1)), 40):02d}", f"p{rng.randrange(25)}") for _ in range(300)] + [(f"h{h:02d}", f"q{p}") for h in (3, 7, 8) for p in range(9)]
    of = defaultdict(set)
    for h, p in pairs:
        of[h].add(p)
    want = {(a, b, len(of[a] & of[b])) for a, b in itertools.combinations(sorted(of), 2) if of[a] & of[b]}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = matching.shared_people(frame(spark, "holder string, person string", *pairs))
        plan = plan_of(df)
        assert {tuple(r) for r in df.collect()} == want
        few = matching.shared_people(frame(spark, "holder string, person string", *pairs), least=3)
        assert {tuple(r) for r in few.collect()} == {w for w in want if w[2] >= 3}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # nothing lies between the expanded pairs and the result but the joins with one row of names per task
    assert "Exchange" not in plan.split("Generate explode(y")[0]


def test_best_overlaps_in_passes(spark, monkeypatch):
    rng = random.Random(6)
    q = {i: {f"t{int(rng.expovariate(0.2))}" for _ in range(6)} for i in range(40)}
    k = {i: {f"t{int(rng.expovariate(0.2))}" for _ in range(7)} for i in range(30)}
    frames = [frame(spark, f"{c} int, tokens array<string>", *[(i, sorted(t)) for i, t in d.items()]) for c, d in (("qid", q), ("kid", k))]
    want = {(i, j, len(a & b)) for i, a in q.items() for j, b in k.items() if a & b and len(a & b) >= max(len(a & c) for c in k.values()) - 1}
    monkeypatch.setattr(overlap, "PAIRS_PER_PASS", 100)
    compared, candidates = [], overlap.candidates
    monkeypatch.setattr(overlap, "candidates", lambda probes, *rest: compared.append(probes.agg({"df": "sum"}).first()[0] or 0) or candidates(probes, *rest))
    got = overlap.best_overlaps(*frames, slack=1)
    assert {(r.qid, r.kid, r.overlap) for r in got.collect()} == want
    # the pairs of some queries at a time
    assert len(compared) > 4 and max(compared) < sum(compared) / 3


def test_nearest_start_brute_force(spark):
    rng = random.Random(4)
    claims = [(f"c{rng.randrange(6)}", f"2020/1/{rng.randrange(1, 29)}", f"2020/2/{rng.randrange(1, 28)}", str(i), "") for i in range(40)]
    starts = [(f"c{rng.randrange(7)}", f"2020-01-{rng.randrange(1, 29):02d}") for _ in range(30)]
    got = {r.cert_no: r.risk_days for r in matching.claim_nearest_policy(
        frame(spark, "cert_no string, risk_date string, report_date string, pre_com string, final_payment string", *claims),
        frame(spark, "insured_cert_no string, insured_start_date string", *starts)).collect()}
    want = {}
    for c, risk, *_ in claims:
        d = dt.date(2020, 1, int(risk.split("/")[2]))
        for s, t in starts:
            gap = (d - dt.date.fromisoformat(t)).days
            if s == c and gap > 0:
                want[c] = min(want.get(c, 99), gap + 1)
    assert got == want


def test_graph_rounds(spark):
    e = frame(spark, "src string, type string, dst string", ("a", "r", "b"), ("b", "r", "c"), ("x", "r", "y"), ("y", "s", "c"), ("c", "r", "d"))
    seeds = lambda *s: frame(spark, "id string", *[(x,) for x in s])
    assert rows(graph.k_hop(seeds("a"), e)) == [("a", "r", "b")]
    assert rows(graph.k_hop(seeds("a", "x"), e).select("src", "type", "dst")) == [("b", "r", "c"), ("y", "s", "c")]
    assert rows(graph.k_hop(seeds("a", "c"), e, hops=1).select("src", "type", "dst")) == [("a", "r", "b"), ("c", "r", "d")]
    assert rows(graph.filter_relations(frame(spark, "src string, type string, dst string", ("a", "lives in", "b"), ("a", "owns", "c")), frame(spark, "token string", ("lives",)))) == [("a", "lives in", "b")]


def test_graph_of_many_questions(spark):
    e = frame(spark, "src string, type string, dst string", ("a", "r", "b"), ("b", "r", "c"), ("x", "r", "y"), ("y", "s", "c"), ("c", "r", "d"), ("m", "r", "n"))
    seeds = frame(spark, "q int, id string", (1, "a"), (2, "a"), (2, "x"), (3, "a"), (3, "m"), (4, "zz"))
    got = graph.k_hop_each(seeds, e, ["q"])
    assert rows(got) == [(1, "a", "r", "b"), (2, "b", "r", "c"), (2, "y", "s", "c"), (3, "a", "r", "b"), (3, "m", "r", "n")]
    nodes = frame(spark, "id string, name string", ("n1", "red car"), ("n2", "blue sky"))
    assert rows(graph.match_nodes(nodes, frame(spark, "q int, token string", (1, "red"), (2, "sky"), (2, "car")), ["q"])) == [(1, "n1"), (2, "n1"), (2, "n2")]


def test_questions_see_their_category_and_the_default(spark):
    k = frame(spark, "id int, query string, answer string, category string", (1, "red car", "x", "work"), (2, "red car", "y", "business"), (3, "red car", "z", "any"))
    seen = matching.by_category(k, "any")
    q = matching.asked_category(frame(spark, "question_id int, question string, category string", (7, "red", "work"), (8, "red", "other"), (9, "red", None)), seen, "any")
    got = matching.qa_topk(q, seen, group=["category"], index=matching.knowledge_index(seen, ["category"]))
    assert rows(got.select("question_id", "id")) == [(7, 1), (7, 3), (8, 3), (9, 3)]


def test_job_type_premium_counts_insured_days(spark):
    policy = frame(spark, "policy_id int, policy_code string, policy_status string, effect_date string", (1, "P", "9", "2020-01-01"), (2, "Q", "1", "2031-01-01"))
    insured = frame(spark, "policy_id int, insured_id string, insured_work_type string", (1, "a", "mason"), (1, "b", "mason"), (1, "c", ""), (2, "d", "mason"))
    term = frame(spark, "policy_id int, insured_id string, insured_start_date string, insured_end_date string", (1, "a", "2020-01-01", "2020-01-10"), (1, "b", "2020-01-01", "2020-12-30"))
    plan = frame(spark, "policy_code string, sku_charge_type string, sku_price double", ("P", "2", 365.0), ("P", "1", 7.0))
    r = premium.job_type_premium(policy, insured, term, plan, "2030-01-01").collect()
    assert [tuple(x) for x in r] == [("mason", 10.0 + 365.0 + 2 * 7.0, 4)]  # the ended cover charges its ten days only


def test_each_plan_of_a_policy_accrues(spark):
    policy = frame(spark, "policy_id int, policy_code string, ent_id string, policy_status string, insure_code string, start_date string, end_date string, sku_charge_type string, sku_price double",
                   (1, "P", "e", "1", "x", "2020-01-01", "2020-01-10", "1", 99.0))
    term = frame(spark, "policy_id int, insured_id string, insured_cert_no string, insured_start_date string, insured_end_date string", (1, "a", "c", "2020-01-01", "2020-01-05"))
    plan = frame(spark, "policy_code string, sku_charge_type string, sku_price double", ("P", "1", 10.0), ("P", "2", 20.0))
    got = premium.premium_to_date(policy, term, "2020-01-03", plan=plan).first()
    assert float(got.charged_premium) == 3 * 2.0 + 3 * 2.0


def test_person_facts_equal_the_single_labels(inputs):
    v = inputs
    facts = {r.ent_id: r for r in enterprise.people_labels(v.policy, v.insured, v.sum_level).collect()}
    single = {
        "total_insured_count": enterprise.insured_times(v.policy, v.insured), "total_insured_persons": enterprise.insured_persons(v.policy, v.insured),
        "cur_insured_persons": enterprise.insured_persons_current(v.policy, v.insured), "insured_rate": enterprise.insured_rate(v.policy, v.insured, v.sum_level),
        "ent_potential_scale": enterprise.potential_headcount(v.policy, v.insured, v.sum_level),
    }
    for name, df in single.items():
        assert {r.ent_id: r[name] for r in df.collect()} == {e: r[name] for e, r in facts.items() if r[name] is not None}, name


def test_names_by_their_rarest_word(spark):
    std = frame(spark, "id int, stype string", (1, "crane driver"), (2, "truck driver"), (3, "cook"))
    names = frame(spark, "name string", ("driver",), ("crane",), ("truck loader",))
    every = rows(matching.worktype_standardise(std, names).select("id", "name", "result"))
    kept = rows(matching.worktype_standardise(std, names, only_contained=True).select("id", "name", "result"))
    assert kept == [x for x in every if x[2] != "-1"] == [(1, "crane", "crane driver"), (1, "driver", "crane driver"), (2, "driver", "truck driver")]


def test_cluster_centres(spark):
    t = frame(spark, "a double, b double", (0.0, 0.0), (1.0, 1.0))
    from surelake.operators import models

    got = models.centres(models.train_kmeans(t, ["a", "b"], k=2), ["a", "b"])
    assert sorted((r.a, r.b) for r in got.collect()) == [(0.0, 0.0), (1.0, 1.0)]


def test_a_missing_id_is_no_second_id(spark):
    f = frame(spark, "insured_name string, insured_cert_no string, insured_mobile string, product_type string",
              ("a", "1", "m", "雇主"), ("a", None, "m", "体育"), ("b", "2", "n", "雇主"), ("b", "3", "n", "雇主"), ("c", None, "o", "ofo"))
    got = {(r.insured_name, r.insured_cert_no): (r.employer, r.sport, r.ofo) for r in facts.product_flags_by_mobile(f).collect()}
    assert got == {("a", "1"): (1, 1, 0), ("a", None): (1, 1, 0), ("b", "2"): (0, 0, 0), ("b", "3"): (0, 0, 0), ("c", None): (0, 0, 1)}


def test_vocabulary(spark):
    t = frame(spark, "text string", *[("手术 骨折",)] * 10, ("骨折 abcd 手",))
    assert rows(matching.vocab_frequent(t)) == [("手术", 10), ("骨折", 11)]


def test_log_lines(spark):
    lines = frame(spark, "value string", ("2020-01-01 00:00:00.123 [ERROR] [main] a.B.run(B.java:1) - no data - here",),
                  ("2020-01-01 00:00:01.123 [WARN ] [main] a.B.run(B.java:1) - x",), ("    at a.B",), ("2020-01-01 00:00:02.123 [ERROR] [main] a.B.run(B.java:1)",))
    got = matching.log_errors(matching.log_parse(lines)).collect()
    assert [tuple(r) for r in got] == [("2020-01-01 00:00:00.123", "[ERROR]", "B.java:1", "no data - here")]


# ------------------------------------------------------------------- models


def test_review_bands(spark):
    r = frame(spark, "ent_id string, cert_no string, report int, person int, value double, risk int", ("e", "1", 0, 0, 30.0, 1), ("e", "2", 2, 2, 5.0, 3), ("e", "3", 5, 0, 5.0, 1), ("e", "4", 0, 0, 50.0, 1))
    got = {x.cert_no: (x.score, x.model_conclusion) for x in M.review_conclusion(r).collect()}
    assert got == {"1": (12.5, "从宽审核"), "2": (100.0, "建议拒绝"), "4": (0.0, "()")}


def test_work_type_share_ties_go_to_the_first(spark):
    w = frame(spark, "ent_id string, ent_scale int, worktype_2_count int, worktype_4_count int", ("e", 10, 3, 3), ("f", None, 1, 5))
    assert {r.ent_id: r.work_type for r in M.risk_features(w).collect()} == {"e": 2.0, "f": 1.0}


def test_models_on_separable_data(spark, tmp_path):
    data = [(i, float(i % 2) * 10 + (i % 5) * 0.1, float(i % 3), float(i % 2)) for i in range(60)]
    df = frame(spark, "id int, a double, b double, y double", *data)
    tree = M.train_tree(df, ["a", "b"], "y")
    M.save(tree, str(tmp_path / "tree"))
    scored = M.load(str(tmp_path / "tree")).transform(df)
    assert {r.metric: r.value for r in M.metrics(scored, "y").collect()} == {"mse": 0.0, "test_error": 0.0}
    km = M.train_kmeans(df, ["a"], k=2)
    assert sorted(r.members for r in M.cluster_sizes(km, df).collect()) == [30, 30]
    costs = {r.k: r.cost for r in M.kmeans_sweep(df, ["a", "b"], (1, 3)).collect()}
    assert costs[1] > costs[3]


def test_policy_owner_and_terms(spark):
    pol = frame(spark, "policy_code string, ent_id string", ("P", "a"), ("P", "b"))
    ent = frame(spark, "id string, create_time string", ("a", "2019"), ("b", "2020"))
    assert rows(base.latest_owner(pol, ent)) == [("P", "b")]
    t = frame(spark, "sku_code string, term_three string, term_one string", ("k", "50123", "1"), ("l", "501", "30"))
    assert rows(base.plan_decode(t)) == [("k", "50", "1", "2", "3"), ("l", "30", None, None, None)]


def test_plan_matrix_multiplicities(spark):
    from surelake.operators import mart

    args = dict(
        snapshot=frame(spark, "policy_id int, day_id string, curr_insured bigint", (1, "20200101", 5)),
        policy=frame(spark, "policy_id int, policy_code string, insure_code string, policy_status string, holder_company string", (1, "P", "1", "1", " A ")),
        insured=frame(spark, "policy_id int, insured_cert_no string", (1, "x"), (1, "x "), (1, "y")),
        plan=frame(spark, "policy_code string, sku_coverage string, sku_price double, sku_charge_type string", ("P", "50", 24.0, "2")),
        product=frame(spark, "product_code string, dim_1 string", ("1", "骑士保")),
        salesman=frame(spark, "ent_id string, ent_name string, channel_name string, salesman string, biz_operator string", ("e", "A", "直客", "s", "o")),
        team=frame(spark, "sale_name string, team_name string", ("s", None)),
        place=frame(spark, "policy_code string, office_province string, office_city string", ("P", "1", "2")),
        place_names=frame(spark, "code string, short_name string", ("1", "北京市"), ("2", "朝阳")),
        claims=frame(spark, "policy_no string, pre_com string, final_payment string", ("P", "10", None), ("P", "20", "5")),
        charged=frame(spark, "policy_id int, day_id string, charged_premium double", (1, "20191230", 1.0), (1, "20191231", 2.0), (1, "20200102", 9.0)),
        work_grade=frame(spark, "policy_code string, profession_type string", ("P", "c")),
        as_of="2020-01-01",
    )
    r = mart.plan_matrix(**args).first()
    assert (r.channel, r.city, r.team_name, r.curr_insured, r.pre_com, r.charged_premium, r.insured_count, r.avg_premium) == ("A", "北京市", "公司", 5, 15.0, 3.0, 2, 2.0)
    r = mart.plan_matrix(**args, repeat_per_join_row=True).first()
    assert (r.curr_insured, r.pre_com, r.charged_premium) == (20, 30.0, 6.0)


def test_ages_and_risk_periods_come_with_the_other_facts(inputs):
    v = inputs
    facts_ = enterprise.people_facts(v.policy, v.insured_detail)
    assert rows(facts_.drop("years", "age_n")) == rows(enterprise.people_facts(v.policy, v.insured))
    assert rows(facts_.select("ent_id", "years", "age_n")) == rows(base.age_sums(v.policy, v.insured_term))
    names = ("ent_id", "avg_aging_risk", "mix_period_count", "mix_period_rate")
    key = lambda r: str(r)
    want = claim.risk_period_labels(v.policy, v.risk_period).select(*names).collect()
    assert sorted(claim.claim_labels(v.claims, v.policy).select(*names).collect(), key=key) == sorted(want, key=key)


def test_all_coverage_labels_in_one_table(inputs):
    v = inputs
    wide = enterprise.insure_labels(v.policy, v.insured, v.endorse, v.summary_month, v.sum_level, v.work_level, v.claims, "2001-08-01")
    single = {r.ent_id: r.total_insured_persons for r in enterprise.insured_persons(v.policy, v.insured).collect()}
    assert {r.ent_id: r.total_insured_persons for r in wide.collect() if r.total_insured_persons is not None} == single
    assert {"month_number", "insured_rate", "ent_first_craft", "ent_potential_scale"} <= set(wide.columns)


def test_people_facts_shuffle_only_counts_that_differ(spark):
    from tests.plan_audit import plan_of

    policy = frame(spark, "policy_id int, ent_id string, policy_status string", (1, "e", "1"), (2, "e", "7"), (3, "e", "4"), (4, "", "1"), (5, "f", "4"), (6, None, "1"))
    man, woman = "110101199001010010", "110101199001010020"
    insured = frame(
        spark, "policy_id int, insured_cert_no string, insure_policy_status string",
        (1, man, "1"), (1, man, "2"), (2, man, "1"), (2, woman, "2"), (3, woman, "1"), (1, "short", "1"), (1, None, "1"), (4, man, "1"), (5, woman, "1"), (6, man, "1"),
    )
    df = enterprise.people_facts(policy, insured)
    got = {r.ent_id: r.asDict() for r in df.collect()}
    facts_of = lambda *values: dict(zip(("total_insured_count", "total_insured_persons", "active", "cur_insured_persons", "gender_n", "men", "active_cards"), values))
    assert got == {
        "e": {"ent_id": "e"} | facts_of(6, 3, 2, 2, 5, 3, 2),
        "f": {"ent_id": "f"} | facts_of(None, None, None, None, 1, 0, None),
        "": {"ent_id": ""} | facts_of(None, None, None, None, 1, 1, None),
    }
    # three counts and a flag of a person under an enterprise, and none under a policy before
    partial = [p.split("functions=[")[1].split("]")[0] for p in plan_of(df).split("HashAggregate(keys=[") if "insured_cert_no" in p.split("]")[0] and "partial_" in p]
    assert {p.count("partial_") for p in partial} == {4}
