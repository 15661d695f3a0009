"""Queries over batches, answers, rules, suggestions and account context."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom import schemas
from codeloom.functions.levels import TRANSACTION
from codeloom.functions.pricing import TRANSACTION_PRICES, estimate_cost
from codeloom.functions.text import code_key, estimate_tokens
from codeloom.operators import audits, batching, evaluation, inference, labels, lob, normalize, rules
from codeloom.operators.frequency import top_descriptions
from codeloom.operators.layers import assign_layers
from codeloom.operators.normalize import conform
from codeloom.plans import account_history as plan
from codeloom.plans import classification, suggestions
from codeloom.plans.uncategorized import uncategorized_catalog
from codeloom.registry import views as v
from codeloom.registry.catalog_queries import LOAN_CATALOG_SQL, SAMPLES_SQL, product_catalog
from codeloom.registry.views import with_views

Query = tuple[Callable[[SparkSession, str], DataFrame], str | None]
QUERIES: dict[str, Query] = {}
STAMP = "2026-01-01 00:00:00"


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = (build, sql)
        return build

    return register


def stamp() -> Column:
    return F.lit(STAMP).cast("timestamp")


# --- the rule table in SQL ----------------------------------------------------------------------------------


def _hit(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, '{pattern}')"


def fires_sql(x: str, rule: rules.Rule) -> str:
    return f"{_hit(x, rule.pattern)} AND NOT {_hit(x, rule.veto)}" if rule.veto else _hit(x, rule.pattern)


def rules_sql(text: str, pick: Callable[[rules.Rule], str], fee_else: str, plain_else: str) -> str:
    x = f"lower({text})"

    def block(table: Sequence[rules.Rule], otherwise: str) -> str:
        return "CASE " + " ".join(f"WHEN {fires_sql(x, r)} THEN {pick(r)}" for r in table) + f" ELSE {otherwise} END"

    fee, plain = block(rules.FEE_BLOCK, fee_else), block(rules.NON_FEE_RULES, plain_else)
    return f"CASE WHEN {_hit(x, rules.FEE_WORDS)} THEN {fee} ELSE {plain} END"


def _literal(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def category_sql(text: str, level: int) -> str:
    other = {0: ("'Fee item'", "'Non-fee item'"), 1: ("'Unclassified'",) * 2}.get(level, ("CAST(NULL AS VARCHAR)",) * 2)
    return rules_sql(text, lambda r: _literal(r.path[level]), *other)


def confidence_sql(text: str) -> str:
    return rules_sql(text, lambda r: f"{r.confidence}::DOUBLE", "0.3::DOUBLE", "0.3::DOUBLE")


def direction_sql(text: str) -> str:
    x = f"lower({text})"
    return f"CASE WHEN {_hit(x, rules.CREDIT_WORDS)} AND NOT {_hit(x, rules.DEBIT_WORDS)} THEN 'Credit' ELSE 'Debit' END"


LINES_SQL = "SELECT line, count(*) AS volume FROM feed GROUP BY 1"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return v.feed(spark, sf).groupBy(F.col("EFHDS1").alias("line")).agg(F.count("*").alias("volume"))


@query("q_rule_classify", with_views("feed", f"""
SELECT line, volume, {', '.join(f'{category_sql("line", i)} AS category_{i + 1}' for i in range(4))}, {confidence_sql('line')} AS confidence
FROM ({LINES_SQL})"""))
def q_rule_classify(spark: SparkSession, sf: str) -> DataFrame:
    placed = _lines(spark, sf).withColumn("_p", rules.transaction_placement("line"))
    return placed.select("line", "volume", "_p.*")


# Where the descriptions of the feed belong, written down by hand rather than derived from the rule tables.
PLACEMENTS_SQL = """
  ('ACH wages from the mill', 'Non-fee item', 'Money movement', 'ACH', NULL, 'Debit'),
  ('ACH rent to landlord', 'Non-fee item', 'Money movement', 'ACH', NULL, 'Debit'),
  ('ACH late return Fee', 'Fee item', 'All others', 'Money movement', 'ACH', 'Debit'),
  ('ATM cash at kiosk 9', 'Non-fee item', 'Money movement', 'ATM', NULL, 'Debit'),
  ('ATM surcharge Fee', 'Fee item', 'All others', 'Money movement', 'ATM', 'Debit'),
  ('ITM envelope deposit', 'Non-fee item', 'Money movement', 'ATM', NULL, 'Credit'),
  ('Check 412 cleared', 'Non-fee item', 'Money movement', 'Check', NULL, 'Debit'),
  ('Cashier check bought', 'Non-fee item', 'Money movement', 'Check', NULL, 'Debit'),
  ('Transfer between own accounts', 'Non-fee item', 'Money movement', 'Transfers & Payments', NULL, 'Debit'),
  ('Loan payment by standing order', 'Non-fee item', 'Money movement', 'Transfers & Payments', NULL, 'Debit'),
  ('Zelle from roommate', 'Non-fee item', 'Money movement', 'Transfers & Payments', NULL, 'Debit'),
  ('Phone camera deposit', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Credit'),
  ('Coin deposit at counter', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Credit'),
  ('Co-op dividend paid in', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Credit'),
  ('Counter withdrawal', 'Non-fee item', 'Money movement', 'Withdrawals', NULL, 'Debit'),
  ('Cash advance taken at desk', 'Non-fee item', 'Money movement', 'Withdrawals', NULL, 'Debit'),
  ('Wire in from supplier', 'Non-fee item', 'Money movement', 'Wire', NULL, 'Debit'),
  ('Foreign wire from Lisbon', 'Non-fee item', 'Money movement', 'Wire', 'International', 'Debit'),
  ('Domestic wire to broker', 'Non-fee item', 'Money movement', 'Wire', 'Domestic', 'Debit'),
  ('Wire handling Fee', 'Fee item', 'All others', 'Money movement', 'Wire', 'Debit'),
  ('POS grocery terminal 3', 'Non-fee item', 'Money movement', 'Debit Card', 'POS', 'Debit'),
  ('POS gym every month', 'Non-fee item', 'Money movement', 'Debit Card', 'POS', 'Debit'),
  ('NSF item presented twice', 'Non-fee item', 'NSF/OD', NULL, NULL, 'Debit'),
  ('Overdraft Fee of May', 'Fee item', 'NSF/OD', NULL, NULL, 'Debit'),
  ('Overdraft Fee reversal of May', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Debit'),
  ('Refund of June NSF Fee', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Credit'),
  ('Closing payout withdrawal', 'Non-fee item', 'Account operations', 'Closing', NULL, 'Debit'),
  ('Stop payment on check 88', 'Non-fee item', 'Account operations', 'Fraud & Stop Payment', NULL, 'Debit'),
  ('Stop payment request Charge', 'Fee item', 'All others', 'Account operations', 'Misc', 'Debit'),
  ('Memo hold by hotel', 'Non-fee item', 'Account operations', 'Memo Posting', NULL, 'Debit'),
  ('Interest on rainy day account', 'Non-fee item', 'Account operations', 'Interest', NULL, 'Debit'),
  ('CD interest third quarter', 'Non-fee item', 'Account operations', NULL, NULL, 'Debit'),
  ('Backup withholding to treasury', 'Non-fee item', 'Account operations', 'Govt. & Tax', NULL, 'Debit'),
  ('Levy by the county', 'Non-fee item', 'Account operations', 'Govt. & Tax', NULL, 'Debit'),
  ('Balance inquiry at night', 'Non-fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Posting error adjustment', 'Non-fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Investment buy order 17', 'Non-fee item', 'Misc', NULL, NULL, 'Debit'),
  ('Cash management sweep in', 'Non-fee item', 'Misc', NULL, NULL, 'Debit'),
  ('Monthly maintenance charge', 'Fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Account upkeep Fee', 'Fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Paper statement Fee', 'Fee item', 'All others', 'Account operations', 'Misc', 'Debit'),
  ('Inactivity Fee', 'Fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Interchange settlement Fee', 'Fee item', 'Interchange', NULL, NULL, 'Debit'),
  ('Insufficient funds event Charge', 'Fee item', 'NSF/OD', NULL, NULL, 'Debit'),
  ('HSA top-up by employer', 'Non-fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Travel money Fee', 'Fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Lobby visit note', 'Non-fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Odd Fee', 'Fee item', 'Unclassified', NULL, NULL, 'Debit'),
  ('Returned item Fee in May', 'Fee item', 'NSF/OD', NULL, NULL, 'Debit'),
  ('Bonus deposit', 'Non-fee item', 'Money movement', 'Deposits', NULL, 'Credit')
"""


@query("q_rule_placements", with_views("feed", f"""
SELECT text AS description, category_1, category_2, category_3, category_4, credit_debit, count(*) AS volume
FROM feed JOIN (VALUES {PLACEMENTS_SQL}) p(description, category_1, category_2, category_3, category_4, credit_debit) ON text = description GROUP BY ALL"""))
def q_rule_placements(spark: SparkSession, sf: str) -> DataFrame:
    """Placement and direction of every description of the feed, against literal rows."""
    texts = v.feed(spark, sf).groupBy("description").agg(F.count("*").alias("volume"))
    placed = texts.withColumn("_p", rules.transaction_placement("description")).withColumn("credit_debit", rules.direction("description"))
    return placed.select("description", "credit_debit", "volume", *[F.col(f"_p.category_{i}") for i in range(1, 5)])


SCORED_SQL = f"coalesce({category_sql('line', 0)} = 'Non-fee item' AND {category_sql('line', 1)} IN ('NSF/OD', 'Money movement'), false)"


@query("q_scoring_flag", with_views("feed", f"""
SELECT {SCORED_SQL} AS include_in_scoring, count(*) AS lines, CAST(sum(volume) AS BIGINT) AS volume FROM ({LINES_SQL}) GROUP BY 1"""))
def q_scoring_flag(spark: SparkSession, sf: str) -> DataFrame:
    placed = _lines(spark, sf).withColumn("_p", rules.transaction_placement("line"))
    flag = rules.include_in_scoring("_p.category_1", "_p.category_2")
    return placed.groupBy(flag.alias("include_in_scoring")).agg(F.count("*").alias("lines"), F.sum("volume").alias("volume"))


@query("q_direction", with_views("feed", f"SELECT line, {direction_sql('line')} AS credit_debit FROM ({LINES_SQL})"))
def q_direction(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select("line", rules.direction("line").alias("credit_debit"))


def flat_label_sql(x: str, vocabulary: dict[str, str]) -> str:
    """Counts whole words by doubling every separator, so that a match may use up the ones around it."""
    low = f"regexp_replace(lower({x}), '[^a-z0-9]', '\\0\\0', 'g')"
    hits = {
        name: f"len(regexp_extract_all({low}, '{rules.word(words.replace(' ', '  ').replace('/', '//'))}'))" for name, words in vocabulary.items()
    }
    best = f"greatest({', '.join(hits.values())})"
    whens = " ".join(f"WHEN {h} = {best} THEN '{name}'" for name, h in hits.items())
    return f"CASE WHEN {best} = 0 THEN NULL {whens} END"


@query("q_flat_label", with_views("feed", f"""
SELECT line, {flat_label_sql('line', labels.BLOCK_LABELS)} AS l1, {flat_label_sql('line', labels.CATEGORY_LABELS)} AS l2 FROM ({LINES_SQL})"""))
def q_flat_label(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).select(
        "line", labels.flat_label("line", labels.BLOCK_LABELS).alias("l1"),
        labels.flat_label("line", labels.CATEGORY_LABELS).alias("l2"),
    )


LANGUAGE_LABELS = {
    "en": "the|and|of|for|is|that", "fr": "le|la|les|un|une|que", "de": "der|die|das|und|ein|ist", "es": "el|los|las|una|con|por",
}


@query("q_flat_label_texts", f"SELECT doc_id, {flat_label_sql('text', LANGUAGE_LABELS)} AS label FROM documents")
def q_flat_label_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A label set of one's own over whole documents."""
    docs = v.table(spark, sf, "documents")
    return docs.select("doc_id", labels.flat_label("text", LANGUAGE_LABELS).alias("label"))


METHOD_SQL = "CASE " + " ".join(f"WHEN {_hit('lower(line)', p)} THEN '{m}'" for m, p in labels.METHODS.items()) + " END"


@query("q_extract", with_views("feed", f"""
SELECT line, {METHOD_SQL} AS transaction_method, {_hit('lower(line)', labels.REVERSAL)} AS is_reversal,
       {_hit('lower(line)', labels.FEE)} AS is_fee, {_hit('lower(line)', labels.REFUND)} AS is_refund FROM ({LINES_SQL})"""))
def q_extract(spark: SparkSession, sf: str) -> DataFrame:
    found = labels.attributes("line")
    return _lines(spark, sf).select("line", *[expr.alias(name) for name, expr in found.items()])


# --- batches and answers ------------------------------------------------------------------------------------

CATALOG_SQL = f"""
counted AS (SELECT code, line AS t, count(*) AS n FROM feed GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY n DESC, t) AS rn, sum(n) OVER (PARTITION BY code) AS volume FROM counted),
cat AS (SELECT code AS transaction_code, CAST(any_value(volume) AS BIGINT) AS volume, {SAMPLES_SQL.format(t='t')} FILTER (rn <= 5) AS description_samples,
               CASE WHEN any_value(ends_with(code, '0')) THEN 3 ELSE 1 END AS layer FROM r GROUP BY 1),
b AS (SELECT *, row_number() OVER (PARTITION BY layer ORDER BY transaction_code) - 1 AS pos FROM cat)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog of the whole feed with two layers."""
    top = top_descriptions(v.feed(spark, sf), "TRANCD", "EFHDS1", 5)
    layer = F.when(F.col("TRANCD").endswith("0"), 3).otherwise(1)
    return top.select(
        F.col("TRANCD").alias("transaction_code"), "volume", "description_samples", F.lit("NON_POS").alias("source_file"), layer.alias("layer")
    )


@query("q_prompt_batches", with_views("feed", f"""WITH {CATALOG_SQL.strip()}
SELECT layer || '-' || (pos // 15) AS batch_id, count(*) AS codes,
       'Classify the ' || count(*) || ' codes listed below.' || chr(10) || chr(10) ||
       string_agg('  - transaction_code=' || transaction_code || ', SAMPLES="' || description_samples || '", VOLUME=' || volume, chr(10) ORDER BY pos) || chr(10) || chr(10) ||
       'Answer with a JSON object whose "classifications" array holds one entry per code.' AS prompt
FROM b GROUP BY 1"""))
def q_prompt_batches(spark: SparkSession, sf: str) -> DataFrame:
    batched = batching.assign_batches(catalog(spark, sf), "layer", ["transaction_code"], batching.TRANSACTION_BATCH)
    requests = batching.batch_requests(batched, batching.transaction_line(), {"code": "transaction_code"})
    return requests.select("batch_id", F.size("items").cast("bigint").alias("codes"), "prompt")


@query("q_batch_numbers", """
SELECT o_orderkey, o_orderpriority, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 30 AS batch_no,
       CAST((row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) % 30 AS INTEGER) AS position
FROM orders""")
def q_batch_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Few large groups cut into fixed-size batches."""
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return batching.assign_batches(orders, "o_orderpriority", ["o_orderkey"], 30).drop("batch_id")


RESULT_SQL = f"""WITH {CATALOG_SQL.strip()}
SELECT transaction_code, layer, volume, {', '.join(f'{category_sql("description_samples", i)} AS category_{i + 1}' for i in range(4))},
       {confidence_sql('description_samples')} AS confidence, {direction_sql('description_samples')} AS credit_debit,
       {SCORED_SQL.replace('lower(line)', 'lower(description_samples)')} AS include_in_scoring, layer || '-NON_POS-' || (pos // 15) AS batch_id, true AS was_requested
FROM b"""
RESULT_COLUMNS = [
    "transaction_code", "layer", "volume", "category_1", "category_2", "category_3", "category_4", "confidence", "credit_debit",
    "include_in_scoring", "batch_id", "was_requested",
]


@query("q_classify_transactions", with_views("feed", RESULT_SQL))
def q_classify_transactions(spark: SparkSession, sf: str) -> DataFrame:
    """The whole classification with the rule table inside the JVM."""
    return classification.classify_transactions(catalog(spark, sf), "v1", stamp()).select(*RESULT_COLUMNS)


@query("q_response_parse", with_views("feed", RESULT_SQL))
def q_response_parse(spark: SparkSession, sf: str) -> DataFrame:
    """The same through a Python backend: prompts out, JSON text back."""
    results = classification.classify_transactions(catalog(spark, sf), "v1", stamp(), backend=inference.rule_backend)
    return results.select(*RESULT_COLUMNS)


def _partial_answers() -> Column:
    """Answers in another letter case. Codes ending in 5 are renamed and thereby left out, those ending in 7 are answered twice, and
    one answer of every batch has no code."""
    def entry(code: Column) -> Column:
        return F.struct(
            code.alias("transaction_code"), *[F.lit("c").alias(f"category_{i}") for i in range(1, 5)],
            F.lit(True).alias("include_in_scoring"), F.lit("Debit").alias("credit_debit"), F.lit(0.5).alias("confidence"),
        )

    def answers(item: Column) -> Column:
        code = item["code"]
        named = F.when(F.endswith(code, F.lit("5")), F.concat(code, F.lit("x"))).otherwise(F.lower(code))
        return F.when(F.endswith(code, F.lit("7")), F.array(entry(named), entry(named))).otherwise(F.array(entry(named)))

    given = F.concat(F.array(entry(F.lit(None).cast("string"))), F.flatten(F.transform("items", answers)))
    return F.to_json(F.struct(given.alias("classifications")), {"ignoreNullFields": "false"})


def _transaction_requests(batched: DataFrame) -> DataFrame:
    return batching.batch_requests(batched, batching.transaction_line(), {
        "code": "transaction_code", "description_samples": "description_samples", "volume": "volume",
        "source_file": "source_file", "layer": "layer",
    })


def _transaction_results(answered: DataFrame) -> DataFrame:
    priced = inference.with_costs(answered, "large", TRANSACTION_PRICES)
    meta = {"description_samples": F.lit(""), "volume": F.lit(0).cast("bigint"), "source_file": F.lit(""), "layer": F.lit(3)}
    answers = inference.read_answers(priced, schemas.TRANSACTION_RESPONSE, "transaction_code", meta)
    return inference.transaction_results(answers, "v1", stamp())


def _incomplete_results(spark: SparkSession, sf: str) -> DataFrame:
    batched = batching.assign_batches(catalog(spark, sf), "layer", ["transaction_code"], batching.TRANSACTION_BATCH)
    answered = _transaction_requests(batched).withColumns(
        {"raw_response": _partial_answers(), "attempts": F.lit(1), "error": F.lit(None).cast("string")}
    )
    return _transaction_results(answered)


INCOMPLETE_SQL = """
SELECT transaction_code, volume, 'c' AS category_1, 'c' AS category_2, 0.5::DOUBLE AS confidence, true AS was_requested, layer FROM b WHERE NOT ends_with(transaction_code, '5')
UNION ALL SELECT transaction_code, 0, 'c', 'c', 0.5, false, 3 FROM b WHERE ends_with(transaction_code, '7')
UNION ALL SELECT transaction_code || 'x', 0, 'c', 'c', 0.5, false, 3 FROM b WHERE ends_with(transaction_code, '5')
UNION ALL SELECT '', 0, 'c', 'c', 0.5, false, 3 FROM b WHERE pos % 15 = 0
UNION ALL SELECT transaction_code, volume, 'ERROR', 'LLM omitted this code from response', 0.0, true, layer FROM b WHERE ends_with(transaction_code, '5')"""


@query("q_completeness", with_views("feed", f"WITH {CATALOG_SQL.strip()}, a AS ({INCOMPLETE_SQL}) SELECT * EXCLUDE (layer) FROM a"))
def q_completeness(spark: SparkSession, sf: str) -> DataFrame:
    """Every code sent has one answer or one error row, whatever null, repeated, renamed and missing codes the answers hold."""
    return _incomplete_results(spark, sf).select(
        "transaction_code", "volume", "category_1", "category_2", "confidence", "was_requested"
    )


@query("q_classify_two_feeds", with_views("feed", """
SELECT CASE l_linestatus WHEN 'F' THEN 'NON_POS' ELSE 'POS' END AS source_file, count(DISTINCT code) AS codes, count(*) AS volume,
       true AS all_requested FROM feed GROUP BY 1"""))
def q_classify_two_feeds(spark: SparkSession, sf: str) -> DataFrame:
    """The catalog of two feeds, whose codes overlap, keeps its rows and volumes of each feed."""
    from codeloom.registry.catalog_queries import q_transaction_catalog

    results = classification.classify_transactions(q_transaction_catalog(spark, sf), "v1", stamp())
    return results.groupBy("source_file").agg(
        F.count("*").alias("codes"), F.sum("volume").alias("volume"), F.bool_and("was_requested").alias("all_requested")
    )


def _backend_with_outages():
    """Answers every batch but those whose first code ends in 3."""
    def backend(prompt: str, items: list[dict]) -> str:
        import json

        if items[0]["code"].endswith("3"):
            raise RuntimeError("no service")
        return json.dumps({"classifications": [
            {"transaction_code": i["code"], "category_1": "c", "category_2": "d", "confidence": 0.5} for i in items
        ]})

    return backend


@query("q_retry_errors", with_views("feed", f"""WITH {CATALOG_SQL.strip()},
down AS (SELECT layer, pos // 15 AS no FROM b WHERE pos % 15 = 0 AND ends_with(transaction_code, '3'))
SELECT transaction_code, volume, CASE WHEN no IS NULL THEN 'c' ELSE 'ERROR' END AS category_1, CASE WHEN no IS NULL THEN 'd' ELSE 'no service' END AS category_2,
       CASE WHEN no IS NULL THEN 0.5::DOUBLE ELSE 0.0 END AS confidence, CASE WHEN no IS NULL THEN 1 ELSE 3 END AS attempts
FROM b LEFT JOIN down ON b.layer = down.layer AND pos // 15 = no"""))
def q_retry_errors(spark: SparkSession, sf: str) -> DataFrame:
    """A backend that is down for some batches: three attempts, then an error row for each of their codes."""
    batched = batching.assign_batches(catalog(spark, sf), "layer", ["transaction_code"], batching.TRANSACTION_BATCH)
    answered = inference.ask(_transaction_requests(batched), _backend_with_outages(), wait=lambda attempt: 0.0)
    return _transaction_results(answered).join(answered.select("batch_id", "attempts"), "batch_id").select(
        "transaction_code", "volume", "category_1", "category_2", "confidence", "attempts"
    )


@query("q_missing_codes", with_views("gt raw_codes", """
SELECT transaction_code, volume FROM raw_codes WHERE transaction_code NOT IN (SELECT transaction_code FROM gt)"""))
def q_missing_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Set difference of codes sent and codes returned."""
    return inference.missing_codes(v.raw_codes(spark, sf), v.truth(spark, sf), [], "transaction_code")


@query("q_error_split", with_views("feed", f"""WITH {CATALOG_SQL.strip()}, a AS ({INCOMPLETE_SQL})
SELECT layer, count(*) FILTER (category_1 <> 'ERROR') AS valid, count(*) FILTER (category_1 = 'ERROR') AS errors FROM a GROUP BY 1"""))
def q_error_split(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and failed rows per layer of a run that left codes out."""
    results = _incomplete_results(spark, sf)
    split = inference.valid_rows(results, "category_1").withColumn("bad", F.lit(False)).unionByName(
        inference.error_rows(results, "category_1").withColumn("bad", F.lit(True))
    )
    return split.groupBy("layer").agg(F.count_if(~F.col("bad")).alias("valid"), F.count_if("bad").alias("errors"))


@query("q_cost_batch", """
WITH d AS (SELECT source, length(text) AS n, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 15 AS b FROM documents),
     c AS (SELECT source, b, count(*) AS codes, CAST(sum(n) AS BIGINT) // 4 AS ti, count(*) * 30 AS tou FROM d GROUP BY 1, 2),
     p AS (SELECT *, (ti * 0.003::DOUBLE + tou * 0.015::DOUBLE) / 1000 AS cost FROM c)
SELECT source, CAST(sum(codes) AS BIGINT) AS codes, count(*) AS batches, CAST(sum(ti) AS BIGINT) AS tokens_in, CAST(sum(tou) AS BIGINT) AS tokens_out,
       round(sum(cost), 6) AS estimated_cost, round(sum(cost * codes), 6) AS cost_by_rows, round(sum(cost) / sum(codes), 6) AS cost_per_code
FROM p GROUP BY 1""")
def q_cost_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Cost of sending whole documents in batches, counted once per batch."""
    docs = v.table(spark, sf, "documents").select("doc_id", "source", F.length("text").alias("n"))
    batched = batching.assign_batches(docs, "source", ["doc_id"], batching.TRANSACTION_BATCH)
    per_batch = batched.groupBy("source", "batch_id").agg(F.sum("n").alias("chars"), F.count("*").alias("codes"))
    tokens_in, tokens_out = F.floor(F.col("chars") / 4).cast("bigint"), (F.col("codes") * 30).cast("bigint")
    priced = per_batch.withColumns({"tokens_in": tokens_in, "tokens_out": tokens_out}).withColumn(
        "estimated_cost", estimate_cost(F.col("tokens_in"), F.col("tokens_out"), F.lit("medium"), TRANSACTION_PRICES)
    )
    rows = batched.select("source", "batch_id").join(priced, ["source", "batch_id"])
    return evaluation.batch_costs(rows, ["source"])


@query("q_token_estimate", """
SELECT doc_id, length(text) // 4 AS tokens, (length(text) // 4 * 0.015::DOUBLE + 100 * 0.075::DOUBLE) / 1000 AS large_cost, 0.0::DOUBLE AS unknown_cost FROM documents""")
def q_token_estimate(spark: SparkSession, sf: str) -> DataFrame:
    tokens = estimate_tokens("text")
    return v.table(spark, sf, "documents").select(
        "doc_id", tokens.alias("tokens"),
        estimate_cost(tokens, F.lit(100), F.lit("large"), TRANSACTION_PRICES).alias("large_cost"),
        estimate_cost(tokens, F.lit(100), F.lit("other"), TRANSACTION_PRICES).alias("unknown_cost"),
    )


# --- products -----------------------------------------------------------------------------------------------


def _first_sql(x: str, table: Sequence[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in table) + f" ELSE {otherwise} END"


NAME = "lower(product_name)"
LOB_SQL = (
    f"CASE WHEN {_hit(NAME, rules.BUSINESS_WORDS)} THEN 'Business' WHEN {_hit(NAME, rules.RETAIL_WORDS)} THEN 'Retail' "
    "WHEN purpose IN ('1', '2') THEN 'Retail' WHEN purpose IN ('3', '4', '5', '6', '9') THEN 'Business' ELSE 'Retail' END"
)
PLACED_SQL = _first_sql(NAME, [
    (f"kind = '{kind}' AND {fires_sql(NAME, r)}" + (f" AND lob = '{only}'" if only else ""), f"'{r.path[0]}'")
    for kind, only, r in rules.PRODUCT_CATEGORY_RULES
], "'Unclassified'")
CERTAINTY_SQL = _first_sql(NAME, [
    (f"kind = '{kind}' AND {fires_sql(NAME, r)}" + (f" AND lob = '{only}'" if only else ""), f"{r.confidence}::DOUBLE")
    for kind, only, r in rules.PRODUCT_CATEGORY_RULES
], "0.3::DOUBLE")


@query("q_classify_products", with_views("loans loan_types deposits types", f"""
WITH loan AS ({LOAN_CATALOG_SQL}),
     dep AS (SELECT sccode AS product_code, count(*) AS account_count, coalesce(any_value(description), '(unknown)') AS product_name
             FROM deposits LEFT JOIN types ON code = sccode
             WHERE sccode IS NOT NULL AND CAST(status AS INTEGER) IN {normalize.DEPOSIT_INCLUDED} GROUP BY 1),
     c AS (SELECT product_code, account_count, product_name, 'Deposit' AS source_file, 'Deposits' AS kind, NULL AS purpose, 1 AS layer FROM dep
           UNION ALL SELECT product_code, account_count, product_name, 'Loan', 'Loans', split_part(purcod_distribution, '"', 2), 3 FROM loan),
     x AS (SELECT *, {LOB_SQL} AS lob, row_number() OVER (PARTITION BY source_file ORDER BY product_code) - 1 AS pos FROM c)
SELECT product_code, product_name, source_file, account_count, layer, lob AS line_of_business, kind AS product_type, {PLACED_SQL} AS product_category,
       {_first_sql(NAME, [(fires_sql(NAME, r), f"'{r.path[0]}'") for r in rules.SUBCATEGORY_RULES], 'NULL')} AS product_subcategory,
       {_first_sql(NAME, [(fires_sql(NAME, r), f"'{r.path[0]}'") for r in rules.SPECIAL_RULES], 'NULL')} AS product_special, {CERTAINTY_SQL} AS confidence,
       'line of business from ' || CASE WHEN {_hit(NAME, rules.BUSINESS_WORDS)} OR {_hit(NAME, rules.RETAIL_WORDS)} THEN 'name'
         WHEN purpose IN ('1', '2', '3', '4', '5', '6', '9') THEN 'purpose distribution' ELSE 'default' END AS reasoning,
       source_file || '-' || (pos // CASE source_file WHEN 'Deposit' THEN 30 ELSE 10 END) AS batch_id, true AS was_requested
FROM x"""))
def q_classify_products(spark: SparkSession, sf: str) -> DataFrame:
    """Deposit and loan catalog through the product rules."""
    results = classification.classify_products(product_catalog(spark, sf), "p1", stamp())
    return results.drop(
        "llm_raw", "run_timestamp", "prompt_version", "model_name", "tokens_in", "tokens_out", "estimated_cost"
    )


FIRST = "upper(regexp_replace(split_part(samples, ' | ', 1), ' \\([0-9,]+\\)$', ''))"
SAMPLE = "lower(samples)"
TYPE_SQL = _first_sql(SAMPLE, [(fires_sql(SAMPLE, r), f"'{r.path[0]}'") for _, r in rules.SUGGESTION_TYPE_RULES], "NULL")
GROUP_SQL = _first_sql(
    SAMPLE, [(fires_sql(SAMPLE, r), f"'{g}'") for g, r in rules.SUGGESTION_TYPE_RULES],
    f"CASE WHEN {_hit(SAMPLE, rules.SERVICE_WORDS)} THEN 'SERVICES' END",
)
SUGGESTED_LOB_SQL = (
    f"CASE WHEN {_hit("replace(lower(samples), 'real estate', '')", rules.FIDUCIARY_WORDS)} THEN 'WEALTH MANAGEMENT' "
    f"WHEN {_hit(SAMPLE, rules.BUSINESS_WORDS)} THEN 'BUSINESS' ELSE 'RETAIL' END"
)


SPECIAL_SQL = _first_sql(SAMPLE, [(fires_sql(SAMPLE, r), f"'{r.path[0]}'") for r in rules.SPECIAL_RULES], "NULL")
SUGGESTED_CERTAINTY_SQL = _first_sql(
    SAMPLE, [(fires_sql(SAMPLE, r), f"{r.confidence}::DOUBLE") for _, r in rules.SUGGESTION_TYPE_RULES], "0.3::DOUBLE"
)
UNCATEGORIZED_SQL = f"""
u AS (SELECT upper(trim(product_ref)) AS product_code, trim(product_desc) AS t, account_status FROM ah
      WHERE NOT EXISTS (SELECT 1 FROM master WHERE upper(trim(core_mapping)) = upper(trim(product_ref)))),
codes AS (SELECT product_code, count(*) AS volume, CASE WHEN bool_or(account_status = 'ACTIVE') THEN 'ACTIVE' ELSE 'INACTIVE' END AS prod_status FROM u GROUP BY 1),
r AS (SELECT product_code, t, count(*) AS n, row_number() OVER (PARTITION BY product_code ORDER BY count(*) DESC, t) AS rn FROM u WHERE t <> '' GROUP BY 1, 2),
c AS (SELECT codes.product_code, any_value(volume) AS volume, any_value(prod_status) AS prod_status, {SAMPLES_SQL.format(t='t')} AS samples
      FROM codes JOIN r USING (product_code) WHERE rn <= 3 GROUP BY 1)"""


def _suggestions(spark: SparkSession, sf: str) -> DataFrame:
    catalog = uncategorized_catalog(v.history(spark, sf), v.master(spark, sf))
    return suggestions.suggest(catalog, "v2.0", stamp())


SUGGESTION_SQL = f"""
SELECT substr(sha256(product_code), 1, 32) AS "PROD_product_type_id", {SUGGESTED_LOB_SQL} AS "PROD_line_of_business",
       coalesce({GROUP_SQL}, '') AS "PROD_product_category", coalesce({TYPE_SQL}, '') AS "PROD_product_type",
       CASE WHEN {TYPE_SQL} IS NOT NULL THEN {FIRST} END AS "PROD_product_name", upper({SPECIAL_SQL}) AS "PROD_product_code", prod_status AS "PROD_status",
       product_code AS "PROD_core_system_mapping", coalesce({GROUP_SQL} = 'LOANS', false) AS "PROD_balance_requires_abs",
       CASE WHEN {SUGGESTED_LOB_SQL} IN ('RETAIL', 'BUSINESS') THEN 'PENDING_REVIEW' ELSE 'REQUIRES_MANUAL_MAPPING' END AS review_status,
       {SUGGESTED_CERTAINTY_SQL} AS confidence, 'rules' AS ai_model, 'v2.0' AS prompt_version, samples AS description_samples, volume
FROM c"""


@query("q_suggestions", with_views("ah master", f"WITH {UNCATEGORIZED_SQL.strip()} {SUGGESTION_SQL}"))
def q_suggestions(spark: SparkSession, sf: str) -> DataFrame:
    return _suggestions(spark, sf).drop("PROD_created_date", "PROD_modified_date", "processing_timestamp").withColumn(
        "confidence", F.col("confidence").cast("double")
    )


@query("q_suggestion_audits", with_views("ah master", f"""WITH {UNCATEGORIZED_SQL.strip()}, s AS ({SUGGESTION_SQL}),
d AS (SELECT CASE WHEN volume % 4 > 0 THEN CASE WHEN volume % 7 = 1 THEN 'same' ELSE "PROD_product_type_id" END END AS id, "PROD_core_system_mapping" AS code,
             CASE WHEN volume % 3 = 0 THEN 'ODD' ELSE "PROD_status" END AS status, CASE WHEN volume % 5 > 0 THEN review_status END AS review,
             CASE WHEN volume % 2 = 0 THEN confidence + 1 ELSE confidence END AS confidence FROM s),
a(audit, col, failing_rows) AS (
  SELECT 'not_null', 'PROD_product_type_id', count(*) FILTER (id IS NULL) FROM d UNION ALL SELECT 'not_null', 'PROD_core_system_mapping', count(*) FILTER (code IS NULL) FROM d
  UNION ALL SELECT 'not_null', 'PROD_status', count(*) FILTER (status IS NULL) FROM d UNION ALL SELECT 'not_null', 'review_status', count(*) FILTER (review IS NULL) FROM d
  UNION ALL SELECT 'accepted_values', 'PROD_status', count(*) FILTER (status NOT IN ('ACTIVE', 'INACTIVE', 'DISCONTINUED')) FROM d
  UNION ALL SELECT 'accepted_values', 'review_status', count(*) FILTER (review NOT IN ('PENDING_REVIEW', 'REQUIRES_MANUAL_MAPPING', 'NEEDS_MANUAL_REVIEW', 'APPROVED', 'REJECTED')) FROM d
  UNION ALL SELECT 'accepted_range', 'confidence', count(*) FILTER (confidence < 0 OR confidence > 1) FROM d
  UNION ALL SELECT 'unique_combination', 'PROD_product_type_id', count(*) FROM (SELECT id FROM d GROUP BY id HAVING count(*) > 1))
SELECT audit, col AS "column", failing_rows, failing_rows = 0 AS passed FROM a"""))
def q_suggestion_audits(spark: SparkSession, sf: str) -> DataFrame:
    """The audits on suggestions of which some were spoiled in every audited column."""
    volume, kept = F.col("volume"), F.col("PROD_product_type_id")
    damaged = _suggestions(spark, sf).withColumns({
        "PROD_product_type_id": F.when(volume % 4 > 0, F.when(volume % 7 == 1, "same").otherwise(kept)),
        "PROD_status": F.when(volume % 3 == 0, "ODD").otherwise(F.col("PROD_status")),
        "review_status": F.when(volume % 5 > 0, F.col("review_status")),
        "confidence": F.col("confidence").cast("double") + F.when(volume % 2 == 0, 1).otherwise(0),
    })
    return audits.suggestion_audits(damaged)


@query("q_suggest_products", with_views("deposits types loans loan_types", f"""
WITH h AS (SELECT sccode AS code, coalesce(description, '(unknown)') AS t, CAST(status AS INTEGER) IN (1, 4, 9, 10) AS active FROM deposits LEFT JOIN types ON code = sccode
           UNION ALL SELECT type, coalesce(nullif(loantype, 'nan'), description, '(unknown)'), status IN (1, 4, 9)
           FROM (SELECT * FROM loans QUALIFY row_number() OVER (PARTITION BY acctno, type ORDER BY o_orderkey) = 1) LEFT JOIN loan_types ON code = type),
     codes AS (SELECT code, count(*) AS volume, CASE WHEN bool_or(active) THEN 'ACTIVE' ELSE 'INACTIVE' END AS prod_status FROM h WHERE code IS NOT NULL GROUP BY 1),
     r AS (SELECT code, t, count(*) AS n, row_number() OVER (PARTITION BY code ORDER BY count(*) DESC, t) AS rn FROM h GROUP BY 1, 2),
     c AS (SELECT codes.code, any_value(volume) AS volume, any_value(prod_status) AS prod_status, {SAMPLES_SQL.format(t='t')} AS samples
           FROM codes JOIN r USING (code) WHERE rn <= 3 GROUP BY 1),
     p AS (SELECT *, {SUGGESTED_LOB_SQL} AS lob, {GROUP_SQL} AS grp, {TYPE_SQL} AS kind FROM c)
SELECT substr(sha256(code), 1, 32) AS "PROD_product_type_id", lob AS "PROD_line_of_business", coalesce(grp, '') AS "PROD_product_category",
       coalesce(kind, '') AS "PROD_product_type", CASE WHEN kind IS NOT NULL THEN {FIRST} END AS "PROD_product_name",
       upper({SPECIAL_SQL}) AS "PROD_product_code",
       prod_status AS "PROD_status", code AS "PROD_core_system_mapping", coalesce(grp = 'LOANS', false) AS "PROD_balance_requires_abs",
       CASE WHEN lob IN ('RETAIL', 'BUSINESS') THEN 'PENDING_REVIEW' ELSE 'REQUIRES_MANUAL_MAPPING' END AS review_status,
       samples AS description_samples, volume FROM p"""))
def q_suggest_products(spark: SparkSession, sf: str) -> DataFrame:
    """Suggestions for the account history of the deposit and loan extracts."""
    history = plan.account_history(
        plan.deposit_history(v.deposits(spark, sf), v.type_list(spark, sf), ["ACCTNO"], stamp()),
        plan.loan_history(v.loans(spark, sf), v.loan_types(spark, sf), ["o_orderkey"], stamp()), None,
    )
    suggested = suggestions.suggest(uncategorized_catalog(history, v.master(spark, sf)), "v2.0", stamp())
    return suggested.drop(
        "PROD_created_date", "PROD_modified_date", "processing_timestamp", "confidence", "ai_model", "prompt_version"
    )


@query("q_master_merge", with_views("ah master", """
WITH s AS (SELECT upper(product_ref) AS k FROM ah GROUP BY 1 HAVING count(*) > (SELECT count(*) / 60 FROM ah)),
     m AS (SELECT *, upper(trim(core_mapping)) AS k FROM master)
SELECT coalesce(type_id, 'new-' || s.k) AS "PROD_product_type_id", coalesce(core_mapping, s.k) AS "PROD_core_system_mapping",
       CASE WHEN s.k IS NOT NULL THEN 'BUSINESS' END AS "PROD_line_of_business"
FROM m FULL JOIN s ON m.k = s.k"""))
def q_master_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Approved suggestions for the busier codes, merged into the master."""
    old = conform(v.master(spark, sf), schemas.PRODUCT_MASTER)
    history = v.history(spark, sf)
    average = history.agg(F.count("*") / v.HISTORY_CODES).scalar()
    busy = history.groupBy(code_key("ProductInstanceReference").alias("k")).agg(F.count("*").alias("n")).filter(F.col("n") > average)
    approved = conform(
        busy.select(
            F.concat(F.lit("new-"), "k").alias("PROD_product_type_id"), F.col("k").alias("PROD_core_system_mapping"),
            F.lit("BUSINESS").alias("PROD_line_of_business"), F.lit("APPROVED").alias("review_status"),
        ),
        schemas.PRODUCT_SUGGESTIONS,
    )
    return suggestions.merge_approved(old, approved).select(
        "PROD_product_type_id", "PROD_core_system_mapping", "PROD_line_of_business"
    )


@query("q_exception_report", with_views("gt raw_codes", """
SELECT transaction_code, volume, 'Unclassified' AS category_2 FROM raw_codes WHERE upper(trim(transaction_code)) NOT IN (SELECT upper(trim(transaction_code)) FROM gt)"""))
def q_exception_report(spark: SparkSession, sf: str) -> DataFrame:
    return suggestions.exception_report(v.raw_codes(spark, sf), v.truth(spark, sf), "transaction_code", "volume")


PURPOSE_SQL = "CASE WHEN purcod IN (1, 2) THEN 'Retail' WHEN purcod IN (3, 4, 5, 6, 9) THEN 'Business' END"
CLASS_SQL = "substr('IBCPGNTEF', CAST(c_nationkey % 9 AS INTEGER) + 1, 1)"


@query("q_purpose_lob", f"""
WITH a AS (SELECT o_orderkey, o_custkey, o_orderkey % 11 + 1 AS purcod FROM orders),
     c AS (SELECT c_custkey, {CLASS_SQL} AS cls FROM customer WHERE c_mktsegment <> 'FURNITURE')
SELECT o_orderkey AS "AccountNumber", {PURPOSE_SQL} AS purpose_lob, cls AS "CFCLAS",
       CASE WHEN cls = 'I' THEN 'Retail' WHEN cls IN ('B', 'C', 'P') THEN 'Business' WHEN cls IN ('T', 'E', 'F') THEN 'Wealth Management' END AS class_lob
FROM a LEFT JOIN c ON o_custkey = c_custkey""")
def q_purpose_lob(spark: SparkSession, sf: str) -> DataFrame:
    """Purpose code and class of the primary owner of every account."""
    orders = v.table(spark, sf, "orders")
    customer = v.table(spark, sf, "customer")
    accounts = orders.select(
        F.col("o_orderkey").alias("AccountNumber"), F.lpad((F.col("o_orderkey") % 11 + 1).cast("string"), 2, "0").alias("PURCOD")
    )
    owners = orders.select(F.col("o_orderkey").alias("AccountNumber"), F.col("o_custkey").alias("CIF"))
    joint = owners.withColumn("CIF", F.col("CIF") + 1).withColumn("Relationship", F.lit("Joint"))
    relationships = owners.withColumn("Relationship", F.lit("Primary")).unionByName(joint)
    classes = customer.filter(F.col("c_mktsegment") != "FURNITURE").select(
        F.col("c_custkey").alias("CIF"),
        F.substring(F.lit("IBCPGNTEF"), F.col("c_nationkey") % 9 + 1, F.lit(1)).alias("CFCLAS"),
    )
    return lob.accounts_with_customer_class(
        lob.with_purpose_lob(accounts, "PURCOD"), relationships, classes, ["AccountNumber", "purpose_lob"],
    )


@query("q_account_context", """
SELECT l_orderkey, l_linenumber, o_orderstatus AS actype, count(*) AS n FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""")
def q_account_context(spark: SparkSession, sf: str) -> DataFrame:
    """Account type brought to every transaction."""
    lines = v.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("account"))
    accounts = v.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("internal"), F.col("o_orderstatus").alias("actype"))
    joined = lob.transactions_with_account_type(lines, accounts, "account", "internal", "actype", ["l_orderkey", "l_linenumber"])
    return joined.groupBy("l_orderkey", "l_linenumber", "actype").agg(F.count("*").alias("n"))


@query("q_pipeline_accuracy", with_views("feed", f"""WITH {CATALOG_SQL.strip()},
t AS (SELECT DISTINCT code AS transaction_code, CASE WHEN ends_with(text, 'Fee') OR ends_with(text, 'Charge') OR ends_with(text, 'charge') THEN 'Fee item' ELSE 'non-fee ITEM' END AS g FROM feed),
x AS (SELECT volume, lower({category_sql('description_samples', 0)}) = lower(g) AS ok FROM b JOIN t USING (transaction_code))
SELECT count(*) AS codes, CAST(sum(volume) AS BIGINT) AS weight, round(avg(CAST(ok AS DOUBLE)), 6) AS "match_L1",
       round(coalesce(sum(volume) FILTER (ok), 0)::DOUBLE / sum(volume), 6) AS "w_match_L1" FROM x"""))
def q_pipeline_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    """Prepare, classify and evaluate in one plan: fee against non-fee for the whole feed."""
    feed = v.feed(spark, sf)
    named = F.col("description")
    none = F.lit(None).cast("string")
    fee = named.endswith("Fee") | named.endswith("Charge") | named.endswith("charge")
    truth = feed.select(
        F.col("TRANCD").alias("transaction_code"), named.alias("gt_desc"),
        F.when(fee, "Fee item").otherwise("non-fee ITEM").alias("gt_L1"), *[none.alias(f"gt_L{i}") for i in (2, 3, 4)],
    ).distinct()
    layered = assign_layers(catalog(spark, sf).drop("layer"), truth, "transaction_code", TRANSACTION.truth)
    results = classification.classify_transactions(layered, "v1", stamp())
    frame = evaluation.layer_one(results, truth, TRANSACTION, "transaction_code", ["gt_desc"], ["gt_desc"])
    return evaluation.accuracy(frame, ["match_L1"], "volume")


@query("q_code_keys", """
SELECT c_custkey, upper(trim(c_name)) AS key FROM customer""")
def q_code_keys(spark: SparkSession, sf: str) -> DataFrame:
    return v.table(spark, sf, "customer").select("c_custkey", code_key(F.concat(F.lit(" \t"), F.lower("c_name"), F.lit("\n"))).alias("key"))
