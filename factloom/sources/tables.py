"""Messages and facts from flat tables.

Each adapter is one SQL text over tables of the same names, so that it means
the same wherever it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Conversations as they are: a message a turn, its parent the turn before.
CHAT = """
SELECT conv_id * 1000 + turn AS message_id, conv_id AS conversation_id, turn AS order_index, role, text,
       CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent_id
FROM conversations
"""

#: Documents as one message each, three roles in turn.
DOCUMENT_MESSAGES = """
SELECT doc_id AS message_id, doc_id % 97 AS conversation_id, doc_id AS order_index, text,
       CASE doc_id % 3 WHEN 0 THEN 'user' WHEN 1 THEN 'assistant' ELSE 'system' END AS role
FROM documents WHERE text IS NOT NULL
"""

#: Statements made of column values: a conversation a customer, a message an order.
UTTERANCES = """
SELECT o_orderkey AS message_id, o_custkey AS conversation_id,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS order_index,
       CASE WHEN o_orderkey % 4 = 3 THEN 'assistant' ELSE 'user' END AS role,
       o_orderdate AS created_at,
       CASE o_orderkey % 12
         WHEN 0 THEN 'I work at ' || org || ' on ' || day
         WHEN 1 THEN 'I live in ' || place || ' since ' || day
         WHEN 2 THEN 'My name is ' || who || ', by the way'
         WHEN 3 THEN 'I work for ' || org || ' on ' || day
         WHEN 4 THEN 'I like ' || thing || ' and that is all'
         WHEN 5 THEN 'I hate ' || thing || ' today'
         WHEN 6 THEN who || ' is my sister, met 3 weeks ago'
         WHEN 7 THEN 'My boss is ' || who || ', hired last month'
         WHEN 8 THEN 'I stopped ' || thing || '. It was fun'
         WHEN 9 THEN 'Actually, that''s not true. See ' || lower(who) || '@' || lower(org) || '.com'
         WHEN 10 THEN 'I have ' || thing || ' here, see https://' || lower(org) || '.org/p' || CAST(o_orderkey AS STRING) || ').'
         ELSE 'Nothing to say in ' || substr(day, 1, 4) || ' about ' || org || ' Group'
       END AS text
FROM (
  SELECT o_orderkey, o_custkey, o_orderdate, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
         CASE (o_custkey * 7 + o_orderkey) % 5 WHEN 0 THEN 'Acme' WHEN 1 THEN 'Globex' WHEN 2 THEN 'Initech' WHEN 3 THEN 'Umbrella' ELSE 'Hooli' END AS org,
         CASE (o_custkey + o_orderkey) % 4 WHEN 0 THEN 'Paris' WHEN 1 THEN 'Berlin' WHEN 2 THEN 'Madrid' ELSE 'Lisbon' END AS place,
         CASE o_custkey % 6 WHEN 0 THEN 'Alice' WHEN 1 THEN 'Bruno' WHEN 2 THEN 'Carla' WHEN 3 THEN 'Dario' WHEN 4 THEN 'Elena' ELSE 'Fabio' END AS who,
         CASE o_orderkey % 7 WHEN 0 THEN 'tea' WHEN 1 THEN 'chess' WHEN 2 THEN 'running' WHEN 3 THEN 'jazz' WHEN 4 THEN 'maps' WHEN 5 THEN 'soup' ELSE 'trains' END AS thing
  FROM orders
) o
"""

#: Facts without text: a subject a user, a predicate an event type.
FACTS = """
SELECT event_id AS assertion_id, user_id AS subject_id, event_type AS predicate,
       'V' || CAST(CAST(floor(value) AS BIGINT) % 4 AS STRING) AS object_signature,
       ts AS asserted_at, CASE WHEN event_id % 11 <> 0 THEN ts END AS valid_from,
       CASE WHEN event_id % 5 = 0 THEN 'assistant' ELSE 'user' END AS role,
       CASE WHEN event_id % 13 = 0 THEN 'negative' ELSE 'positive' END AS polarity,
       CASE WHEN event_id % 17 = 0 THEN 'question' WHEN event_id % 3 = 0 THEN 'preference' ELSE 'state' END AS modality,
       CAST(60 + event_id % 40 AS DOUBLE) / 100 AS confidence,
       1 + event_id % 4 AS tier
FROM events
"""


def register(spark: SparkSession, sf_dir: str, *tables: str) -> None:
    """The tables of a folder as views of their names."""
    for table in tables:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)


def chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """message_id, conversation_id, order_index, role, text, parent_id."""
    register(spark, sf_dir, "conversations")
    return spark.sql(CHAT)


def document_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """message_id, conversation_id, order_index, text, role."""
    register(spark, sf_dir, "documents")
    return spark.sql(DOCUMENT_MESSAGES)


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """message_id, conversation_id, order_index, role, created_at, text."""
    register(spark, sf_dir, "orders")
    return spark.sql(UTTERANCES)


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """assertion_id, subject_id, predicate, object_signature, asserted_at, valid_from, role, polarity, modality, confidence, tier."""
    register(spark, sf_dir, "events")
    return spark.sql(FACTS)
