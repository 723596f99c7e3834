"""Queries over attribute policies and queue settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.functions.policy import policy_condition
from tidegate.operators.filtering import filter_counters, filter_messages, flag_messages
from tidegate.plans.envelopes import QUEUES, event_messages, events
from tidegate.plans.registry import EVENTS_SQL, query
from tidegate.session import run_dir
from tidegate.sources.messages import (
    project_attributes, queue_assignment, queue_list, read_messages, union_queues,
)
from tidegate.sources.queues import land_messages

POLICIES = {
    "filter_none": (None, "TRUE"),
    "filter_exact": ('{"Type":["error","purchase"]}', "event_type IN ('error', 'purchase')"),
    "filter_number_text": ('{"price":[6.55,12.3,100.00]}', "price IN ('6.55', '12.3', '100.00')"),
    "filter_prefix": (
        '{"Type":[{"prefix":"p"},{"prefix":"si"}]}',
        "event_type LIKE 'p%' OR event_type LIKE 'si%'",
    ),
    "filter_exists": ('{"vip":[{"exists":true}]}', "vip"),
    "filter_not_exists": ('{"vip":[{"exists":false}]}', "NOT vip"),
    "filter_numeric": ('{"price":[{"numeric":[">=",100]}]}', "price_number >= 100"),
    "filter_numeric_equal": (
        '{"price":[{"numeric":["=",6.55]},{"numeric":["==",12.31]}]}',
        "price_number IN (6.55, 12.31)",
    ),
    "filter_numeric_unequal": ('{"price":[{"numeric":["!=",6.55]}]}', "price_number <> 6.55"),
    "filter_numeric_on_text": ('{"Type":[{"numeric":["<",5]}],"vip":[{"exists":true}]}', "FALSE"),
    "filter_numeric_range": (
        '{"price":[{"numeric":[">",5,"<=",50.5]}]}',
        "price_number > 5 AND price_number <= 50.5",
    ),
    "filter_and_or": (
        '{"Type":["click",{"prefix":"sign"}],"vip":[{"exists":true}],"price":[{"numeric":["<",20]}]}',
        "event_type IN ('click', 'signup') AND vip AND price_number < 20",
    ),
}

for _name, (_policy, _where) in POLICIES.items():
    query(
        _name,
        f"WITH {EVENTS_SQL} SELECT message_id, queue_url, body FROM ev WHERE {_where}",
    )(
        lambda spark, sf_dir, policy=_policy: filter_messages(
            event_messages(spark, sf_dir), policy
        ).select("message_id", "queue_url", "body")
    )


@query(
    "filter_landed",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, queue_url, body FROM ev
    WHERE event_type IN ('error', 'view') AND (NOT vip OR price LIKE '1%')""",
)
def filter_landed(spark, sf_dir):
    """Messages written to a landing folder and read back, with attributes as columns."""
    path = run_dir(spark, "landing")
    land_messages(event_messages(spark, sf_dir), path, ["Type", "vip"])
    landed = read_messages(spark, path, promoted=["Type", "vip"])
    rows = landed.where(policy_condition('{"Type":["error",{"prefix":"vi"}]}', promoted=("Type",)))
    either = filter_messages(rows, '{"vip":[{"exists":false}]}').unionByName(
        filter_messages(rows, '{"vip":["gold"],"price":[{"prefix":"1"}]}')
    )
    return either.select("message_id", "queue_url", "body")


def landed_in_parts(spark, sf_dir, names: list[str]):
    """A landing folder whose files were written without, with one, and with another
    promoted attribute, read with all of them."""
    path = run_dir(spark, "landing-mixed")
    messages = event_messages(spark, sf_dir)
    part = F.col("message_id").cast("bigint") % 3
    for i, promoted in enumerate(([], ["vip"], ["Type"])):
        land_messages(messages.where(part == i), path, promoted)
    return read_messages(spark, path, promoted=names)


@query(
    "filter_landed_mixed",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, vip AS has_vip FROM ev WHERE event_type IN ('error', 'view')""",
)
def filter_landed_mixed(spark, sf_dir):
    landed = landed_in_parts(spark, sf_dir, ["Type", "vip"])
    kinds = '"Type":["error",{"prefix":"vi"}]'
    halves = [
        filter_messages(landed, f'{{{kinds},"vip":[{{"exists":{wanted}}}]}}').select(
            "message_id", F.lit(wanted == "true").alias("has_vip")
        )
        for wanted in ("true", "false")
    ]
    return halves[0].unionByName(halves[1])


@query(
    "filter_promoted_projection",
    f"""WITH {EVENTS_SQL}, cases(name) AS (VALUES ('off'), ('other'), ('named'))
    SELECT name, event_id % 3 AS part, COUNT(*) AS messages,
           COUNT(*) FILTER (name = 'named' AND vip) AS passed
    FROM ev, cases GROUP BY ALL""",
)
def filter_promoted_projection(spark, sf_dir):
    """An attribute that was not asked for is absent, promoted or not."""
    landed = landed_in_parts(spark, sf_dir, ["Type", "vip"])
    frames = []
    for name, enabled, names in (("off", False, None), ("other", True, "Type"), ("named", True, "vip")):
        seen = flag_messages(project_attributes(landed, enabled, names), '{"vip":[{"exists":true}]}')
        frames.append(seen.groupBy(
            F.lit(name).alias("name"), (F.col("message_id").cast("bigint") % 3).alias("part")
        ).agg(F.count("*").alias("messages"), F.count_if("passed").alias("passed")))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "filter_empty_list",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, CAST(0 AS BIGINT) AS messages_passed, COUNT(*) AS messages_filtered
    FROM ev GROUP BY queue_url""",
)
def filter_empty_list(spark, sf_dir):
    return filter_counters(event_messages(spark, sf_dir), '{"Type":[]}', ["queue_url"])


@query(
    "filter_stats",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url,
           COUNT(*) FILTER (event_type IN ('error', 'purchase') AND price_number >= 5) AS messages_passed,
           COUNT(*) FILTER (NOT (event_type IN ('error', 'purchase') AND price_number >= 5)) AS messages_filtered
    FROM ev GROUP BY queue_url""",
)
def filter_stats(spark, sf_dir):
    policy = '{"Type":["error","purchase"],"price":[{"numeric":[">=",5]}]}'
    return filter_counters(event_messages(spark, sf_dir), policy, ["queue_url"])


def attribute_summary(df):
    names = F.concat_ws(",", F.array_sort(F.map_keys("message_attributes")))
    system = F.concat_ws(",", F.array_sort(F.map_keys("attributes")))
    return df.select("message_id", names.alias("user_names"), system.alias("system_names"))


SYSTEM_NAMES_SQL = """
  CASE WHEN fifo THEN 'ApproximateFirstReceiveTimestamp,ApproximateReceiveCount,MessageDeduplicationId,MessageGroupId,SentTimestamp,SequenceNumber'
       ELSE 'ApproximateFirstReceiveTimestamp,ApproximateReceiveCount,SentTimestamp' END"""


@query(
    "attribute_projection",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, CASE WHEN vip THEN 'Type,vip' ELSE 'Type' END AS user_names,
           {SYSTEM_NAMES_SQL} AS system_names FROM ev""",
)
def attribute_projection(spark, sf_dir):
    return attribute_summary(project_attributes(event_messages(spark, sf_dir), True, " Type, ,vip "))


@query(
    "attribute_projection_all",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, CASE WHEN vip THEN 'Type,price,vip' ELSE 'Type,price' END AS user_names,
           'ApproximateFirstReceiveTimestamp,ApproximateReceiveCount,SentTimestamp' AS system_names FROM ev""",
)
def attribute_projection_all(spark, sf_dir):
    return attribute_summary(project_attributes(event_messages(spark, sf_dir), True, "", fifo=False))


@query(
    "attribute_projection_off",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, '' AS user_names, {SYSTEM_NAMES_SQL} AS system_names FROM ev""",
)
def attribute_projection_off(spark, sf_dir):
    return attribute_summary(project_attributes(event_messages(spark, sf_dir), False, "Type"))


@query(
    "filter_after_projection",
    f"""WITH {EVENTS_SQL}
    SELECT message_id, queue_url FROM ev WHERE event_type = 'click'""",
)
def filter_after_projection(spark, sf_dir):
    """Attributes that were not fetched count as missing."""
    kept = project_attributes(event_messages(spark, sf_dir), True, "Type")
    policy = '{"Type":["click"],"price":[{"exists":false}]}'
    return filter_messages(kept, policy).select("message_id", "queue_url")


@query(
    "queue_union",
    f"""WITH {EVENTS_SQL}
    SELECT queue_url, COUNT(*) AS messages, MIN(t_ms) AS first_ms, MAX(t_ms) AS last_ms
    FROM ev GROUP BY queue_url""",
)
def queue_union(spark, sf_dir):
    messages = event_messages(spark, sf_dir)
    frames = [(q, messages.where(F.col("queue_url") == q).drop("queue_url")) for q in QUEUES]
    t = F.unix_millis("received_at")
    return union_queues(frames).groupBy("queue_url").agg(
        F.count("*").alias("messages"), F.min(t).alias("first_ms"), F.max(t).alias("last_ms")
    )


LISTS_SQL = """
lists AS (
  SELECT event_id,
         CASE WHEN user_id % 5 = 0 THEN ' , '
              ELSE 'q' || CAST(user_id % 4 AS VARCHAR) || ', q' || CAST(user_id % 3 AS VARCHAR)
                   || ',,q' || CAST(user_id % 4 AS VARCHAR) || ' ,' || event_type || ',' END AS urls,
         CASE WHEN user_id % 10 = 0 THEN ' single ' ELSE '' END AS single
  FROM events
), cleaned AS (
  SELECT event_id, trim(single) AS single,
         list_filter(list_transform(string_split(urls, ','), lambda u: trim(u)), lambda u: u <> '') AS listed
  FROM lists
), normal AS (
  SELECT event_id,
         CASE WHEN len(listed) > 0
              THEN list_filter(listed, lambda u, i: list_position(listed, u) = i)
              WHEN single <> '' THEN [single] ELSE [] END AS queues
  FROM cleaned
)"""


def queue_lists(spark, sf_dir):
    user = F.col("user_id")
    urls = F.when(user % 5 == 0, " , ").otherwise(
        F.concat(
            F.lit("q"), (user % 4).cast("string"), F.lit(", q"), (user % 3).cast("string"),
            F.lit(",,q"), (user % 4).cast("string"), F.lit(" ,"), F.col("event_type"), F.lit(","),
        )
    )
    single = F.when(user % 10 == 0, " single ").otherwise("")
    return events(spark, sf_dir).select("event_id", queue_list(urls, single).alias("queues"))


@query(
    "queue_list_normalize",
    f"""WITH {LISTS_SQL}
    SELECT event_id, len(queues) AS n_queues, array_to_string(queues, '|') AS queues FROM normal""",
)
def queue_list_normalize(spark, sf_dir):
    return queue_lists(spark, sf_dir).select(
        "event_id", F.size("queues").cast("bigint").alias("n_queues"),
        F.concat_ws("|", "queues").alias("queues"),
    )


@query(
    "queue_assignment",
    f"""WITH {LISTS_SQL}, spread AS (
      SELECT event_id, len(queues) AS n, unnest(queues) AS queue_url,
             CAST(unnest(range(len(queues))) AS BIGINT) AS position
      FROM normal
    )
    SELECT event_id, queue_url, position,
           CAST(CASE WHEN n = 1 THEN 2 WHEN position < 2 THEN 1 ELSE 0 END AS BIGINT) AS workers
    FROM spread""",
)
def queue_assignment_report(spark, sf_dir):
    return queue_assignment(queue_lists(spark, sf_dir), F.col("queues"), 2, ["event_id"])
