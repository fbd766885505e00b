"""The registered queries: every operator, run over whole tables.

Each takes (spark, folder) and returns a DataFrame.  ``oracles`` holds the SQL
that gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimscale import fixed
from claimscale.functions import folding, sentences, stems
from claimscale.functions import text as T
from claimscale.functions import topics as P
from claimscale.operators import (
    aggregates,
    bayes_topics,
    dictionary,
    joins,
    ranking,
    topic_map,
    topic_model,
)
from claimscale.operators.compute import with_computed
from claimscale.plans import compare, disclosure, news, standins
from claimscale.plans.standins import table
from claimscale.sources import bundles, exports, files, tables
from claimscale.sources.files import spread
from claimscale.sources.staging import fresh_path, stage
from claimscale.streaming import ingest

DIGITS = 6
HEAD = 10


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Round for comparison: sums differ in the last digits by their order."""
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _topics(spark: SparkSession) -> DataFrame:
    return files.topic_dimension(spark)


# --- distributions -------------------------------------------------------------


def argmax_topic(spark: SparkSession, folder: str) -> DataFrame:
    scored = topic_model.with_best_topic(standins.disclosures(spark, folder))
    return _rounded(scored.select("vec_id", "probability", "topic_id"), "probability")


def sql_function(spark: SparkSession, folder: str) -> DataFrame:
    P.register_sql_functions(spark)
    standins.disclosures(spark, folder).createOrReplaceTempView("scored_statements")
    called = spark.sql(
        "SELECT top_topic(probabilities) AS topic_id, "
        "top_probability(probabilities) AS probability, * FROM scored_statements"
    )
    return _rounded(
        called.select("vec_id", "organisation", "topic_id", "probability"), "probability"
    )


def labelled_distribution(spark: SparkSession, folder: str) -> DataFrame:
    labelled = aggregates.label_distribution(standins.disclosures(spark, folder))
    exploded = aggregates.explode_topics(labelled).drop("probabilities")
    return _rounded(exploded, "probability")


def indexed_distribution(spark: SparkSession, folder: str) -> DataFrame:
    exploded = aggregates.explode_positions(
        standins.disclosures(spark, folder), ["vec_id"]
    )
    named = joins.lookup_join(exploded, _topics(spark), ["topic_id"])
    return _rounded(named.withColumnRenamed("probability", "esg"), "esg")


# --- disclosure scores ---------------------------------------------------------


def _initiatives(spark: SparkSession, folder: str) -> DataFrame:
    scored = topic_model.with_best_topic(standins.disclosures(spark, folder))
    return disclosure.initiatives(scored, _topics(spark), ["vec_id"])


def _csr_scores(spark: SparkSession, folder: str) -> DataFrame:
    chosen = stage(_initiatives(spark, folder), "initiatives")
    return disclosure.csr_scores(chosen, "organisation")


def top_initiatives(spark: SparkSession, folder: str) -> DataFrame:
    chosen = _initiatives(spark, folder).orderBy(F.desc("probability"), "vec_id")
    return _rounded(
        chosen.select(
            "organisation", "vec_id", "topic", "policy", "topic_id", "probability"
        ),
        "probability",
    )


def topic_mass(spark: SparkSession, folder: str) -> DataFrame:
    mass = aggregates.topic_mass(standins.disclosures(spark, folder))
    return _rounded(mass.select("topic_id", "organisation", "esg"), "esg")


def rank_score_rounded(spark: SparkSession, folder: str) -> DataFrame:
    return _csr_scores(spark, folder)


def score_by_pillar(spark: SparkSession, folder: str) -> DataFrame:
    named = compare.scored_with_topics(_csr_scores(spark, folder), _topics(spark))
    means = aggregates.average_by(named, ["organisation", "topic"], "score")
    return _rounded(means, "score")


def pivot_pillar(spark: SparkSession, folder: str) -> DataFrame:
    named = compare.scored_with_topics(_csr_scores(spark, folder), _topics(spark))
    return _rounded(compare.pillar_matrix(named), *fixed.PILLARS)


def initiative_focus(spark: SparkSession, folder: str) -> DataFrame:
    focus = compare.initiative_matrix(_initiatives(spark, folder), _topics(spark))
    return _rounded(focus, *[x["policy"] for x in fixed.TOPIC_LABELS])


# --- news ----------------------------------------------------------------------


def _classified(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.label_distribution(standins.classified_news(spark, folder))


def weighted_tone(spark: SparkSession, folder: str) -> DataFrame:
    toned = aggregates.weighted_tone(_classified(spark, folder))
    return _rounded(toned, "weightedTone", "weights", "esg")


def rank_score_plain(spark: SparkSession, folder: str) -> DataFrame:
    scores = news.news_scores(_classified(spark, folder))
    return _rounded(
        scores.select("organisation", "policy", "topic", "topic_id", "esg", "score"),
        "esg",
        "score",
    )


def pivot_policy_scaled(spark: SparkSession, folder: str) -> DataFrame:
    toned = aggregates.weighted_tone(_classified(spark, folder))
    return _rounded(
        compare.policy_matrix(toned), *[x["policy"] for x in fixed.TOPIC_LABELS]
    )


def pivot_pillar_news(spark: SparkSession, folder: str) -> DataFrame:
    scores = news.news_scores(_classified(spark, folder))
    return _rounded(compare.pillar_matrix(scores), *fixed.PILLARS)


def walk_the_talk(spark: SparkSession, folder: str) -> DataFrame:
    walk = news.news_scores(_classified(spark, folder))
    talk = _csr_scores(spark, folder)
    return _rounded(compare.walk_the_talk(walk, talk), "walk", "talk")


def articles_per_day(spark: SparkSession, folder: str) -> DataFrame:
    path = files.path_in_sql(f"{folder}/events.parquet")
    return spark.sql(
        f"""
        SELECT count(*) AS article_count, to_date(ts) AS date,
               concat('org_', user_id % 10) AS organisation
        FROM {path}
        GROUP BY to_date(ts), concat('org_', user_id % 10)
        ORDER BY date, organisation
        """
    )


def articles_per_day_frame(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.articles_per_day(standins.news(spark, folder))


def distinct_organisations(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.distinct_count(
        standins.news(spark, folder), "organisation", "organisations"
    )


def rows_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.rows_per_key(table(spark, folder, "events"), "user_id")


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_type", "user_id").distinct()


def latest_n_per_key(spark: SparkSession, folder: str) -> DataFrame:
    articles = standins.news(spark, folder).drop("event_id")
    latest = news.latest_per_key(articles, "organisation", "date")
    return _rounded(latest, "tone")


def latest_n_cut_first(spark: SparkSession, folder: str) -> DataFrame:
    articles = standins.news(spark, folder).drop("event_id")
    latest = news.latest_per_key(articles, "organisation", "date", many_copies=False)
    return _rounded(latest, "tone")


def prefix_theme(spark: SparkSession, folder: str) -> DataFrame:
    themes = F.array(F.col("event_type"), F.concat(F.lit("tag_"), F.col("event_type")))
    return (
        table(spark, folder, "events")
        .withColumn("themes", themes)
        .filter(P.any_starts_with(F.col("themes"), "tag_c"))
        .select("event_id", "event_type", "user_id")
    )


def _prepared_news(spark: SparkSession, folder: str, latest: int) -> DataFrame:
    """A third of the events are off the theme, a tenth of the pages have no title."""
    pages = table(spark, folder, "pages")
    size = pages.select(F.count(F.lit(1)).alias("n")).scalar()
    markup = F.when(F.col("page_id") % 10 == 0, F.replace("html", F.lit("<title>"), F.lit("<t>")))
    markup = F.coalesce(markup, "html")
    titled = with_computed(spread(pages), "title", T.title(markup, "title"))
    theme = F.when(F.col("event_id") % 3 == 0, "OTHER_").otherwise("UNGP_")
    raw = (
        table(spark, folder, "events")
        .withColumn("page_id", F.col("event_id") % size)
        .join(titled.select("page_id", "url", "title"), "page_id")
        .select(
            F.col("ts").alias("publishDate"),
            F.col("user_id").alias("ticker"),
            F.array(F.concat(theme, "event_type")).alias("themes"),
            "title",
            F.col("url").alias("documentIdentifier"),
            F.struct((F.col("value") - 100).alias("tone")).alias("tone"),
            F.col("event_type").alias("sourceCommonName"),
        )
    )
    organisations = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("ticker"), F.lower("c_name").alias("organisation")
    )
    prepared = news.prepare_news(raw, organisations, ["organisation"], latest=latest)
    return _rounded(prepared, "tone")


def prepared_news(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared_news(spark, folder, fixed.LATEST_PER_TICKER)


def prepared_news_latest_20(spark: SparkSession, folder: str) -> DataFrame:
    return _prepared_news(spark, folder, 20)


# --- text ----------------------------------------------------------------------


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents"))


def paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    return T.explode_paragraphs(_documents(spark, folder), "text", ["doc_id"])


def clean_statements(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.clean_statements(
        _documents(spark, folder), "text", ["doc_id", "source"]
    )


def statement_arrays(spark: SparkSession, folder: str) -> DataFrame:
    found = _documents(spark, folder).select(
        "doc_id", T.statements(F.col("text")).alias("statements")
    )
    return found.select(
        "doc_id",
        F.size("statements").alias("statements"),
        F.md5(F.array_join("statements", "\n")).alias("digest"),
    )


def folded_text(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", T.fold(F.col("text")).alias("folded")
    )


def tokens(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder).select(
        "doc_id",
        F.size(T.tokens("text")).alias("n_tokens"),
        T.normalised_text("text").alias("normalised"),
    )


def term_counts(spark: SparkSession, folder: str) -> DataFrame:
    split = _documents(spark, folder).select(T.tokens("text").alias("tokens"))
    return topic_model.term_counts(split)


def ranked_terms(spark: SparkSession, folder: str) -> DataFrame:
    """The vocabulary of the statements, as the topic model takes it."""
    statements = clean_statements(spark, folder)
    tokens = statements.select(T.tokens("statement").alias("tokens"))
    return topic_model.ranked_terms(tokens)


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    """The distinct tokens of all documents."""
    split = spread(table(spark, folder, "documents")).select(T.tokens("text").alias("tokens"))
    return dictionary.term_counts(split)


def word_stems(spark: SparkSession, folder: str) -> DataFrame:
    return stems.stems(_terms(spark, folder).select("term"))


def word_lemmas(spark: SparkSession, folder: str) -> DataFrame:
    return stems.lemmas(_terms(spark, folder).select("term"))


def folded_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Words as they stand in the texts, and without accents and compatibility forms."""
    word = F.explode(F.split("text", fixed.TOKEN_BREAK)).alias("term")
    words = spread(table(spark, folder, "documents")).select(word).filter(F.col("term") != "")
    return folding.folded_terms(words.distinct())


def stem_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Every term with its stem, and the number of the stem by its count."""
    split = spread(table(spark, folder, "documents")).select(T.tokens("text").alias("tokens"))
    known = dictionary.dictionary(stage(split, "tokens"), bases=stems.stems)
    return known.select("term_id", "term", "base", "count", "is_first")


def term_bags(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, term_id, n: documents as numbered terms, by the distributed dictionary."""
    split = spread(table(spark, folder, "documents")).select("doc_id", T.tokens("text").alias("tokens"))
    split = stage(split, "tokens")
    known = stage(dictionary.dictionary(split), "dictionary")
    bags = dictionary.term_bags(split, known, ["doc_id"])
    return bags.select("doc_id", F.inline("bag"))


# --- learned sentences ------------------------------------------------------------


def _clean_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(table(spark, folder, "documents"))
    return stage(T.explode_clean_paragraphs(documents, "text", ["doc_id"]), "paragraphs")


def word_stops(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.word_stops(sentences.word_places(_clean_paragraphs(spark, folder), "paragraph"))


def abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    """Words by how surely they are abbreviations, all that stand before a full stop."""
    places = sentences.word_places(_clean_paragraphs(spark, folder), "paragraph")
    scored = sentences.abbreviation_scores(stage(sentences.word_stops(places), "stops"))
    return _rounded(scored.withColumn("score", F.when(F.col("score") > 0, F.col("score")).otherwise(0.0)), "score")


def sentence_starters(spark: SparkSession, folder: str) -> DataFrame:
    _, starters, _ = sentences.scores(_clean_paragraphs(spark, folder))
    return _rounded(starters, "score")


def learned_statements(spark: SparkSession, folder: str) -> DataFrame:
    """Statements as clean_statements, with sentence ends learned from these documents."""
    rule = sentences.rule(_clean_paragraphs(spark, folder))
    documents = spread(table(spark, folder, "documents"))
    return T.explode_statements(
        documents, "text", ["doc_id"], split=rule.split, mark=rule.mark
    ).select("doc_id", "paragraph_no", "sentence_no", "statement")


def page_titles(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "pages")
        .select("page_id", T.title(F.col("html"), "title").alias("title"))
        .filter(F.length("title") > 0)
    )


def page_text(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "pages")).select(
        "page_id", T.markup_text(F.col("html")).alias("text")
    )


def joined_pages(spark: SparkSession, folder: str) -> DataFrame:
    pages = F.split("text", "\n\n")
    return table(spark, folder, "documents").select(
        "doc_id", T.join_pages(pages).alias("text")
    )


def key_from_path(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("s3://b.x/pdf/"), F.col("source"), F.lit(".pdf"))
    return table(spark, folder, "documents").select(
        "doc_id", T.file_key(path).alias("ticker")
    )


def preview(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id", T.preview(F.col("text")).alias("preview")
    )


def first_rows(spark: SparkSession, folder: str) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(HEAD)
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


# --- joins ---------------------------------------------------------------------


def metadata_join(spark: SparkSession, folder: str) -> DataFrame:
    metadata = table(spark, folder, "labels")
    documents = table(spark, folder, "documents").select("doc_id", "source", "lang")
    joined = joins.lookup_join(documents, metadata, ["doc_id"])
    return joined.withColumnRenamed("source", "organisation").withColumn(
        "organisation", F.lower("organisation")
    )


def delimited_join(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "nations")
    files.write_delimited(table(spark, folder, "nation"), path)
    nations = files.read_delimited(
        spark, path, "n_nationkey int, n_name string, n_regionkey int"
    )
    suppliers = table(spark, folder, "supplier").withColumnRenamed(
        "s_nationkey", "n_nationkey"
    )
    return joins.lookup_join(suppliers, nations, ["n_nationkey"]).select(
        "s_suppkey", "s_name", "n_name"
    )


def split_key_join(spark: SparkSession, folder: str) -> DataFrame:
    """The join that is used once a lookup side is too large to broadcast."""
    orders = table(spark, folder, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = table(spark, folder, "customer")
    joined = joins.split_join(
        orders.select("c_custkey", "o_orderkey"),
        customers.select("c_custkey", "c_name", "c_mktsegment"),
        ["c_custkey"],
        staged=True,
    )
    return joined


def rank_by_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The ranking that is used once a few groups hold too many rows."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice"
    )
    return ranking.rank_by_ranges(
        orders, ["o_orderstatus"], [F.asc("o_totalprice"), F.asc("o_orderkey")]
    )


# --- tables --------------------------------------------------------------------


def insert_and_append(spark: SparkSession, folder: str) -> DataFrame:
    name = f"{tables.fresh_schema(spark)}.labels_by_number"
    tables.create_table(spark, name, "columnA INT, columnB STRING", ["columnA"])
    tables.insert_values(
        spark, name, ["columnA", "columnB"], "(1, 'one'), (2, 'two'), (60, 'SQL')"
    )
    rows = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("columnA"), F.col("c_name").alias("columnB")
    )
    tables.append_table(rows, name, ["columnA"])
    more = files.local_rows(
        spark, [(60, "PYTHON")], "columnA int, columnB string"
    ).withColumn("columnB", F.concat(F.lit("local "), F.col("columnB")))
    tables.append_table(more, name, ["columnA"])
    return spark.table(name).select("columnA", "columnB")


def external_table(spark: SparkSession, folder: str) -> DataFrame:
    """An external table, moved to another schema; its files stay in place."""
    legacy, schema = tables.fresh_schema(spark), tables.fresh_schema(spark)
    path = fresh_path(spark, "external")
    files.replace_path(table(spark, folder, "customer"), path)
    declared = "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE"
    tables.create_table(spark, f"{legacy}.declared", declared, location=path)
    tables.move_external(spark, f"{legacy}.declared", f"{schema}.moved")
    tables.register_files(spark, f"{schema}.found", path)
    moved = spark.table(f"{schema}.moved").select("c_custkey", "c_name")
    found = spark.table(f"{schema}.found").select("c_custkey", "c_mktsegment")
    return moved.join(found, "c_custkey")


def ctas_copy(spark: SparkSession, folder: str) -> DataFrame:
    """Partitioned table, its migration by CTAS, and a full copy of it."""
    schema = tables.fresh_schema(spark)
    tables.replace_table(
        table(spark, folder, "orders"), f"{schema}.legacy", ["o_orderstatus"]
    )
    tables.create_table_as(
        spark, f"{schema}.migrated", f"SELECT * FROM {schema}.legacy"
    )
    tables.copy_table(spark, f"{schema}.legacy", f"{schema}.copied")
    tables.drop_table(spark, f"{schema}.legacy", must_exist=True)
    migrated = spark.table(f"{schema}.migrated").select("o_orderkey", "o_orderstatus")
    copied = spark.table(f"{schema}.copied").select("o_orderkey", "o_totalprice")
    return migrated.join(copied, "o_orderkey")


def table_names(spark: SparkSession, folder: str) -> DataFrame:
    """One table under its three names; the rows carry the number of parts."""
    schema = tables.fresh_schema(spark)
    tables.replace_table(
        table(spark, folder, "supplier").select("s_suppkey", "s_name"),
        f"{schema}.suppliers",
    )
    long, middle, short = tables.table_names(schema, "suppliers")
    before = spark.catalog.currentDatabase()
    tables.use_schema(spark, schema)
    try:
        by_short = spark.sql(f"SELECT 1 AS parts, * FROM {short}")
    finally:
        tables.use_schema(spark, before)
    by_middle = spark.sql(f"SELECT 2 AS parts, * FROM {middle}")
    by_long = spark.sql(f"SELECT 3 AS parts, * FROM {long}")
    return by_short.unionByName(by_middle).unionByName(by_long)


def partition_export(spark: SparkSession, folder: str) -> DataFrame:
    """A partitioned table; one partition of it exported under another name."""
    name = f"{tables.fresh_schema(spark)}.orders"
    tables.replace_table(table(spark, folder, "orders"), name, ["o_orderstatus"])
    path = exports.export_table(
        spark.table(name),
        fresh_path(spark, "export"),
        "report_share",
        "reports",
        "orders_open",
        partition={"o_orderstatus": "O"},
    )
    return exports.read_export(spark, path).select("o_orderkey", "o_totalprice")


def export_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """List what is exported, with the rows that a reader finds in each table."""
    target = fresh_path(spark, "export")
    share, schema = "report_share", "reports"
    orders = table(spark, folder, "orders")
    paths = {"orders": exports.export_table(orders, target, share, schema, "orders")}
    for status in ("F", "P"):
        name = f"orders_{status.lower()}"
        paths[name] = exports.export_table(
            orders, target, share, schema, name, partition={"o_orderstatus": status}
        )
    counted = None
    for name, path in paths.items():
        one = exports.read_export(spark, path).agg(F.count(F.lit(1)).alias("rows"))
        one = one.select(F.lit(name).alias("table"), "rows")
        counted = one if counted is None else counted.unionByName(one)
    listed = exports.exported_tables(spark, target).drop("path")
    return listed.join(counted, "table")


def shared_table_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Read an exported table by path and sum per key, largest first."""
    joined = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    path = exports.export_table(
        joined.select("c_nationkey", "o_totalprice"),
        fresh_path(spark, "export"),
        "open_share",
        "default",
        "order_values",
    )
    shared = exports.read_export(spark, path)
    sums = aggregates.sum_per_key(shared, "c_nationkey", "o_totalprice", "total")
    return sums.withColumn("total", F.round("total", 2))


def shared_table_sql(spark: SparkSession, folder: str) -> DataFrame:
    """The same kind of export, registered and queried by name."""
    name = f"{tables.fresh_schema(spark)}.sql_table"
    path = exports.export_table(
        table(spark, folder, "lineitem").select("l_suppkey", "l_quantity"),
        fresh_path(spark, "export"),
        "open_share",
        "default",
        "quantities",
    )
    tables.drop_table(spark, name)
    exports.register_export(spark, path, name)
    return spark.sql(
        f"SELECT l_suppkey, sum(l_quantity) AS total FROM {name} GROUP BY l_suppkey"
    )


def sum_per_key_desc(spark: SparkSession, folder: str) -> DataFrame:
    sums = aggregates.sum_per_key(
        table(spark, folder, "lineitem"), "l_suppkey", "l_extendedprice", "total"
    )
    return sums.withColumn("total", F.round("total", 2))


def clustered_write(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "clustered")
    lines = table(spark, folder, "lineitem")
    files.replace_path(
        files.clustered(lines, "l_suppkey", ["l_orderkey", "l_linenumber"]), path
    )
    return files.read_path(spark, path).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )


def clustered_by_several(spark: SparkSession, folder: str) -> DataFrame:
    """Clustered so that readers can skip files by supplier and by day."""
    path = fresh_path(spark, "clustered")
    lines = table(spark, folder, "lineitem")
    columns, spread_by = ["l_suppkey", "l_shipdate"], ["l_orderkey", "l_linenumber"]
    placed = files.clustered_by(lines, columns, spread_by, target_bytes=8 * 1024 * 1024)
    files.replace_path(placed, path)
    return files.read_path(spark, path).select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")


def json_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Topic labels read back from JSON, joined to the best topic of each row."""
    path = fresh_path(spark, "labels")
    _topics(spark).coalesce(1).write.json(path)
    scored = topic_model.with_best_topic(standins.disclosures(spark, folder))
    named = joins.lookup_join(scored, files.read_json(spark, path), ["topic_id"])
    return named.select("vec_id", "topic_id", "topic", "policy")


# --- documents as files ----------------------------------------------------------


PAGES_PER_DOCUMENT = 10
BUNDLE_BYTES = 4 * 1024 * 1024


def _document_files(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Pages bound to documents of ten pages, many of these in a file."""
    number = F.col("page_id") % PAGES_PER_DOCUMENT
    page = F.when(number == 0, F.col("html")).otherwise(
        F.concat(F.lit(fixed.PAGE_BREAK), "html")
    )
    pages = spread(table(spark, folder, "pages")).select(
        F.expr(f"page_id div {PAGES_PER_DOCUMENT}").alias("ticker"),
        "page_id",
        page.alias("page"),
    )
    path = fresh_path(spark, "documents")
    return path, bundles.write_bundles(pages, "ticker", "page", path, ["page_id"], BUNDLE_BYTES)


def _document_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("ticker"),
        F.col("source").alias("organisation"),
        F.col("lang").alias("description"),
    )


def binary_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files, read in batch and joined with their metadata."""
    path, key = _document_files(spark, folder)
    scanned = bundles.documents_in(files.read_binary(spark, path, "*.txt"))
    return ingest.join_metadata(scanned, _document_metadata(spark, folder), key)


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files, drained through a stream into a table."""
    name = f"{tables.fresh_schema(spark)}.raw_documents"
    path, key = _document_files(spark, folder)
    stream = bundles.documents_in(ingest.file_stream(spark, path, glob="*.txt"))
    joined = ingest.join_metadata(stream, _document_metadata(spark, folder), key)
    ingest.drain_to_table(joined, name, fresh_path(spark, "checkpoint"))
    return spark.table(name)


def stream_large_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """The same stream, joined batch by batch as metadata beyond any broadcast ask for."""
    name = f"{tables.fresh_schema(spark)}.raw_documents"
    path, key = _document_files(spark, folder)
    stream = bundles.documents_in(ingest.file_stream(spark, path, glob="*.txt", files_per_batch=4))
    metadata = _document_metadata(spark, folder)
    checkpoint = fresh_path(spark, "checkpoint")
    ingest.drain_joined(stream, metadata, name, checkpoint, key, max_bytes=0)
    return spark.table(name).drop("batch")


def logo_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Logos as binary files ⋈ the organisations they belong to."""
    suppliers = table(spark, folder, "supplier")
    path = fresh_path(spark, "logos")
    key = bundles.write_bundles(suppliers, "s_suppkey", "s_name", path)
    nations = table(spark, folder, "nation")
    organisations = suppliers.join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").cast("string").alias("ticker"),
        F.lower("s_name").alias("organisation"),
        F.col("n_name").alias("description"),
    )
    logos = bundles.documents_in(files.read_binary(spark, path, "*.txt"))
    joined = ingest.organisation_metadata(logos, organisations, key)
    return joined.withColumn("logo_content", T.strip(F.decode("logo_content", "UTF-8")))


# --- topics of a term table -----------------------------------------------------

LANGUAGES = ["de", "en", "es", "fr"]
LANGUAGE_PRIOR = 0.25


def _language_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Terms of the documents with their occurrences by language, as a matrix of topics."""
    split = spread(table(spark, folder, "documents")).select("lang", F.explode(T.tokens("text")).alias("term"))
    counts = [F.count_if(F.col("lang") == code) + LANGUAGE_PRIOR for code in LANGUAGES]
    grouped = split.groupBy("term").agg(F.count(F.lit(1)).alias("count"), F.array(*counts).alias("weights"))
    return stage(grouped, "matrix")


def relevant_terms(spark: SparkSession, folder: str) -> DataFrame:
    rows = topic_map.relevant_terms(_language_terms(spark, folder), len(LANGUAGES), 20)
    return _rounded(rows, "share", "lift", "relevance")


def topic_distances(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(topic_map.topic_distances(_language_terms(spark, folder), len(LANGUAGES)), "distance")


# --- topic model -----------------------------------------------------------------

STATEMENT_ID = ("doc_id", "paragraph_no", "sentence_no")
PASSES = 10

_fits: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def _fitted(spark: SparkSession, folder: str):
    """The model of a folder's statements, and these; fitted once per session."""
    known = (spark.sparkContext.applicationId, folder)
    if known not in _fits:
        statements = stage(clean_statements(spark, folder), "statements")
        path = fresh_path(spark, "model")
        model = bayes_topics.fit(statements, order=STATEMENT_ID, passes=PASSES, path=path)
        topic_model.save_model(model, path, fixed.TOPIC_LABELS)
        _fits[known] = path, statements
    path, statements = _fits[known]
    return topic_model.load_model(path), statements


def topic_model_fit(spark: SparkSession, folder: str) -> DataFrame:
    """How well the model tells the texts' words, against their plain frequencies.

    The entropy is what a word costs by frequencies alone; a model that has learned
    topics needs less, and every pass raises the bound of the likelihood.
    """
    model, statements = _fitted(spark, folder)
    told = bayes_topics.log_likelihood(model, statements)
    counts = model.matrix().filter("is_first").select("count")
    n = counts.select(F.sum("count")).scalar()
    share = F.col("count") / n
    usual = counts.agg(
        F.count(F.lit(1)).alias("terms"), F.round(-F.sum(share * F.log(share)), DIGITS).alias("entropy")
    )
    rises = all(b - a > -1e-6 * abs(a) for a, b in zip(model.bounds, model.bounds[1:]))
    needed = -told.select(F.col("log_likelihood") / F.col("tokens")).scalar()
    tokens = told.select("tokens").scalar()
    return usual.select(
        "terms",
        tokens.alias("tokens"),
        "entropy",
        (needed < F.col("entropy") - 0.05).alias("is_better"),
        F.lit(rises and len(model.bounds) > 1).alias("is_rising"),
    )


def topic_model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Fit, save, load again, and score every statement with both models."""
    model, statements = _fitted(spark, folder)
    path = fresh_path(spark, "model")
    topic_model.save_model(model, path, fixed.TOPIC_LABELS)
    loaded = topic_model.load_model(path)
    topic_model.check_labels(loaded, topic_model.load_labels(path))
    own = topic_model.score_topics(model, statements)
    other = topic_model.distributions(loaded, statements.select(*STATEMENT_ID, "statement"))
    other = other.select(*STATEMENT_ID, F.col("probabilities").alias("again"))
    p, best = F.col("probabilities"), F.col("topic_id")
    apart = F.zip_with(p, "again", lambda a, b: F.abs(a - b))
    before = F.slice(p, F.lit(1), best)
    return own.join(other, list(STATEMENT_ID)).select(
        *STATEMENT_ID,
        ((F.col("probability") > 0) & (F.col("probability") <= 1)).alias("is_share"),
        (
            (F.get(p, best) == F.array_max(p))
            & (F.size(F.filter(before, lambda x: x >= F.get(p, best))) == 0)
        ).alias("is_first_best"),
        (F.array_max(apart) < 1e-9).alias("is_same_reloaded"),
    )


def distribution_mass(spark: SparkSession, folder: str) -> DataFrame:
    """Topics and total probability per statement: always 1."""
    model, statements = _fitted(spark, folder)
    p = F.col("probabilities")
    return topic_model.distributions(model, statements).select(
        *STATEMENT_ID,
        F.size(p).alias("topics"),
        F.round(F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x), DIGITS).alias("mass"),
    )


def topic_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Ten terms per topic: whether weights fall and the terms are the corpus's own."""
    model, statements = _fitted(spark, folder)
    terms = topic_model.topic_terms(model)
    heavier = F.lag("weight").over(Window.partitionBy("topic_id").orderBy("rank"))
    split = statements.select(T.tokens("statement").alias("tokens"))
    known = topic_model.term_counts(split).select("term", F.lit(True).alias("known"))
    falling = terms.withColumn("falls", F.coalesce(F.col("weight") <= heavier, F.lit(True)))
    return falling.join(known, "term", "left").select(
        "topic_id",
        F.col("rank").cast("int").alias("rank"),
        "falls",
        F.coalesce("known", F.lit(False)).alias("known"),
    )


def scored_view(spark: SparkSession, folder: str) -> DataFrame:
    """The model seen from SQL: statements with their distribution, as a view."""
    model, statements = _fitted(spark, folder)
    statements.createOrReplaceTempView("model_statements")
    topic_model.register_scored_view(spark, model, "model_statements", "scored_statements_view")
    return spark.sql(
        "SELECT doc_id, count(*) AS statements, "
        "round(sum(aggregate(probabilities, 0D, (acc, x) -> acc + x)), 6) AS mass "
        "FROM scored_statements_view GROUP BY doc_id"
    )


def modelled_news(spark: SparkSession, folder: str) -> DataFrame:
    """The whole way: the model learned from documents scores page titles."""
    model, _ = _fitted(spark, folder)
    pages = table(spark, folder, "pages").select(
        F.col("page_id"), "url", T.title(F.col("html"), "title").alias("title")
    )
    size = pages.select(F.count(F.lit(1)).alias("n")).scalar()
    # Titles belong to pages: each is scored once, however many articles share the page.
    classified = stage(news.classify_news(model, pages, columns=("page_id", "url", "title")), "titles")
    events = table(spark, folder, "events").select(
        (F.col("event_id") % size).alias("page_id"),
        F.col("ts").alias("date"),
        F.concat(F.lit("org_"), (F.col("user_id") % 10).cast("string")).alias("organisation"),
        (F.col("value") - 100).alias("tone"),
    )
    scores = news.news_scores(events.join(classified, "page_id"))
    n = F.count(F.lit(1)).over(Window.partitionBy("policy"))
    place = F.row_number().over(Window.partitionBy("policy").orderBy("score"))
    even = F.abs(F.col("score") - place * 100 / n) < 1e-9
    return scores.select("organisation", "policy", "topic_id", even.alias("is_even_rank"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        walk_the_talk,
        argmax_topic,
        sql_function,
        labelled_distribution,
        indexed_distribution,
        top_initiatives,
        topic_mass,
        rank_score_rounded,
        rank_score_plain,
        score_by_pillar,
        pivot_pillar,
        pivot_pillar_news,
        initiative_focus,
        pivot_policy_scaled,
        weighted_tone,
        articles_per_day,
        articles_per_day_frame,
        distinct_organisations,
        rows_per_key,
        distinct_rows,
        latest_n_per_key,
        latest_n_cut_first,
        prefix_theme,
        prepared_news,
        prepared_news_latest_20,
        paragraphs,
        clean_statements,
        statement_arrays,
        folded_text,
        tokens,
        term_counts,
        ranked_terms,
        word_stems,
        word_lemmas,
        folded_terms,
        stem_dictionary,
        term_bags,
        word_stops,
        abbreviations,
        sentence_starters,
        learned_statements,
        relevant_terms,
        topic_distances,
        page_titles,
        page_text,
        joined_pages,
        key_from_path,
        preview,
        first_rows,
        metadata_join,
        delimited_join,
        split_key_join,
        rank_by_ranges,
        insert_and_append,
        external_table,
        ctas_copy,
        table_names,
        partition_export,
        export_manifest,
        shared_table_sums,
        shared_table_sql,
        sum_per_key_desc,
        clustered_write,
        clustered_by_several,
        json_dimension,
        binary_scan,
        stream_ingest,
        stream_large_metadata,
        logo_metadata,
        topic_model_fit,
        topic_model_scores,
        distribution_mass,
        topic_terms,
        scored_view,
        modelled_news,
    )
}
