import pytest

from tidegate.functions.policy import PolicyError
from tidegate.operators.filtering import filter_counters, filter_messages, flag_messages
from tests.helpers import frame, in_order, message

CASES = [
    ('{"Type":["order","payment"]}', [{"Type": "order"}, {"Type": "payment"}, {"Type": "notification"}, {}], "1100"),
    ('{"Environment":[{"prefix":"prod-"}]}',
     [{"Environment": e} for e in ("prod-east", "prod-west", "dev-local", "staging")], "1100"),
    ('{"Priority":[{"exists":true}]}', [{"Priority": "high"}, {"Type": "order"}, {"Priority": "low"}], "101"),
    ('{"Priority":[{"exists":false}]}', [{"Priority": "high"}, {"Type": "order"}, {"Priority": "low"}], "010"),
    ('{"price":[{"numeric":[">", 100]}]}', [{"price": p} for p in ("150", "50", "200")], "101"),
    ('{"quantity":[{"numeric":["<", 10]}]}', [{"quantity": p} for p in ("5", "15", "3")], "101"),
    ('{"Type":["order"],"Priority":["high"]}',
     [{"Type": "order", "Priority": "high"}, {"Type": "order", "Priority": "low"},
      {"Type": "payment", "Priority": "high"}, {"Type": "order"}], "1000"),
    ('{"Status":["pending","processing","completed"]}',
     [{"Status": s} for s in ("pending", "failed", "completed", "cancelled")], "1010"),
    ('{"Type":["order",{"prefix":"urgent-"}],"Region":[{"exists":true}]}',
     [{"Type": "order", "Region": "us-east"}, {"Type": "urgent-alert", "Region": "eu-west"},
      {"Type": "payment", "Region": "us-west"}, {"Type": "order"}], "1100"),
    (None, [{"a": "b"}, {}], "11"),
    ("  ", [{"a": "b"}, {}], "11"),
    ("{}", [{"a": "b"}, {}], "11"),
    ('{"a":[]}', [{"a": "b"}, {}], "00"),
    ('{"a":[{"suffix":"b"}]}', [{"a": "b"}, {}], "00"),
    ('{"a":[100]}', [{"a": "100"}, {"a": "100.0"}], "10"),
    ('{"a":[{"numeric":["=",100]}]}', [{"a": "100"}, {"a": "100.0"}, {"a": "1e2"}, {"a": " 100 "}, {"a": "x"}], "11110"),
    ('{"a":[{"numeric":["!=",1]}]}', [{"a": "NaN"}, {"a": "1"}, {"a": "nan"}, {"a": "2"}, {}], "10010"),
    ('{"a":[{"numeric":[">",1]}]}', [{"a": "NaN"}, {"a": "Infinity"}, {"a": "inf"}], "010"),
    ('{"a":[{"numeric":["<",50,">=",10]}]}', [{"a": "9"}, {"a": "10"}, {"a": "49.9"}, {"a": "50"}], "0110"),
    ('{"a":[{"numeric":["~",50]}]}', [{"a": "50"}], "0"),
    ('{"a":[{"exists":"true"}]}', [{"a": "x"}, {}], "01"),
    ('{"a":["x",{"exists":true}]}',
     [{"a": {"data_type": "Binary", "string_value": None, "binary_value": b"x"}}], "1"),
    ('{"a":["x",{"prefix":"x"}]}',
     [{"a": {"data_type": "Binary", "string_value": None, "binary_value": b"x"}}], "0"),
]


@pytest.mark.parametrize("policy,users,expected", CASES)
def test_policy(spark, policy, users, expected):
    df = frame(spark, [message(f"msg-{i}", user=u) for i, u in enumerate(users)])
    flags = in_order(flag_messages(df, policy), "passed")
    assert "".join(str(int(f)) for f in flags) == expected


@pytest.mark.parametrize("policy", ["invalid json", "[1]", '{"a":1}', '{"a":[[1]]}', '{"a":[{"prefix":"x","exists":true}]}'])
def test_broken_policy_is_refused(spark, policy):
    with pytest.raises(PolicyError):
        filter_messages(frame(spark, [message()]), policy)


def test_counters(spark):
    df = frame(spark, [message(f"msg-{i}", user={"n": str(i)}) for i in range(5)])
    row = filter_counters(df, '{"n":[{"numeric":["<",2]}]}').first()
    assert (row.messages_passed, row.messages_filtered) == (2, 3)


def test_promoted_attributes_reach_the_scan(spark, tmp_path):
    from tidegate.sources.messages import read_messages
    from tidegate.sources.queues import land_messages

    binary = {"data_type": "Binary", "string_value": None, "binary_value": b"x"}
    users = [{"Type": "order"}, {"Type": "urgent-1"}, {"Type": "other"}, {}, {"Type": binary}]
    df = frame(spark, [message(f"msg-{i}", user=u) for i, u in enumerate(users)])
    land_messages(df, str(tmp_path / "in"), ["Type"])
    landed = read_messages(spark, str(tmp_path / "in"), promoted=["Type"])
    kept = filter_messages(landed, '{"Type":["order",{"prefix":"urgent-"}]}')
    assert sorted(r.message_id for r in kept.collect()) == ["msg-0", "msg-1"]
    leaves = kept._jdf.queryExecution().executedPlan().collectLeaves()
    pushed = " ".join(leaves.apply(i).metadata().apply("PushedFilters") for i in range(leaves.size()))
    assert "EqualTo(promoted.Type.text,order)" in pushed and "StringStartsWith(promoted.Type.text,urgent-)" in pushed
    for policy in ('{"Type":[{"exists":true}]}', '{"Type":[{"exists":false}]}', '{"Type":["other",{"numeric":["<",1]}]}'):
        plain = in_order(flag_messages(df, policy), "passed")
        assert in_order(flag_messages(landed, policy), "passed") == plain
