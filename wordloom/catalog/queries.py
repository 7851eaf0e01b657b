"""One query per operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.catalog.session import documents_index, pages_index, work_folder
from wordloom.functions.analysis import drop_stop_words, stem, tokenize
from wordloom.operators import changes as C
from wordloom.operators import clauses as Q
from wordloom.operators import postings as P
from wordloom.operators.topk import top_k
from wordloom.plans.clause_table import score_clauses
from wordloom.plans.search import Searcher
from wordloom.plans.store import IndexStore
from wordloom.plans.sync import sync, sync_tree
from wordloom.sources.extract import DEFAULT_EXTRACTORS, extract, html_page, route
from wordloom.sources.files import documents_corpus, has_type, pages_scan, spread
from wordloom.sources.tree import list_files, read_files, write_files
from wordloom.streaming.ingest import ingest, read_feed

CONTENT = ("content",)


def _corpus(spark, sf) -> DataFrame:
    return spread(documents_corpus(spark, sf), "doc_id")


# -- sources ------------------------------------------------------------------


def scan_ext_filter(spark, sf):
    pages = pages_scan(spark, sf)
    return pages.where(has_type(F.col("path"))).select(F.col("doc_id").alias("page_id"), "path")


def route_by_type(spark, sf):
    chosen = route(F.col("path"), DEFAULT_EXTRACTORS, "plain")
    return pages_scan(spark, sf).select(F.col("doc_id").alias("page_id"), "path", chosen.alias("route"))


def plain_docs(spark, sf):
    return documents_corpus(spark, sf).select("doc_id", "path", "title", "content")


def html_text(spark, sf):
    title, content = html_page(F.col("path"), F.col("text"))
    pages = spread(pages_scan(spark, sf), "doc_id")
    return pages.select(F.col("doc_id").alias("page_id"), title.alias("title"), content.alias("content"))


def extractor_routes(spark, sf):
    """An extractor of one's own: the first line of a text as its title."""

    def first_line(path, text):
        return F.trim(F.substring_index(text, "\n", 1)), text

    pages = spread(pages_scan(spark, sf), "doc_id").select("path", "text")
    texts = documents_corpus(spark, sf).select("path", F.col("content").alias("text"))
    docs = extract(pages.unionByName(texts), {**DEFAULT_EXTRACTORS, ".txt": first_line})
    return docs.select("path", "title", F.length("content").cast("bigint").alias("n_chars"))


def content_md5(spark, sf):
    docs = documents_corpus(spark, sf)
    return docs.select("doc_id", C.fingerprint(F.col("content")).alias("content_md5"))


def _tree_rows(spark, sf) -> DataFrame:
    """The documents as files, three of four under a hidden name or folder, every seventh of another type."""
    hidden = F.element_at(F.array(*map(F.lit, ("", "_", ".", ".more/_"))), (F.abs("doc_id") % 4 + 1).cast("int"))
    ending = F.when(F.col("doc_id") % 7 == 0, ".md").otherwise(".txt")
    name = F.concat(F.coalesce("source", F.lit("none")), F.lit("/"), hidden, F.col("doc_id").cast("string"), ending)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    return spread(docs.select("doc_id", name.alias("name"), F.coalesce("text", F.lit("")).alias("text")), "doc_id")


def _below(folder: str, path: str = "path"):
    """A path as seen from the folder of the tree."""
    return F.substring_index(path, f"/{folder.rsplit('/', 1)[1]}/", -1)


def scan_tree(spark, sf):
    """Every file of a tree, hidden names included, written from the documents."""
    folder, work = work_folder(spark), work_folder(spark)
    write_files(_tree_rows(spark, sf).drop("doc_id"), folder)
    found = read_files(list_files(spark, folder, work), folder)
    return found.select(_below(folder).alias("path"), "length", C.fingerprint(F.col("bytes")).alias("content_md5"))


def sync_stamps(spark, sf):
    """Three syncs of a tree: all of it, unchanged, and with other, fewer and more files."""
    folder = work_folder(spark)
    rows = _tree_rows(spark, sf)
    write_files(rows.where("doc_id % 11 <> 1").drop("doc_id"), folder)
    store = IndexStore(spark, work_folder(spark), buckets=8, shards=8)
    sync_tree(store, folder)
    sync_tree(store, folder)
    other = F.when(F.col("doc_id") % 11 == 2, F.concat("text", F.lit(" again"))).when(F.col("doc_id") % 11 == 1, F.col("text"))
    write_files(rows.where("doc_id % 11 in (1, 2, 3)").select("name", other.alias("text")), folder)
    return sync_tree(store, folder).changes.select(_below(folder).alias("path"), "state")


# -- changes ------------------------------------------------------------------


def _previous(spark, sf) -> DataFrame:
    """An earlier state of the documents: no Spanish ones yet, other French
    texts, and German ones that have since been removed."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    name = F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    text = F.when(F.col("lang") == "fr", F.concat("text", F.lit("x"))).otherwise(F.col("text"))
    title = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    live = docs.where(F.col("lang") != "es").select(
        "doc_id", name.alias("path"), title.alias("title"), text.alias("content")
    )
    ghosts = docs.where(F.col("lang") == "de").select(
        # Ids of their own, outside the range of the table's.
        (-F.col("doc_id") - 1).alias("doc_id"),
        F.concat(F.lit("ghost/"), name).alias("path"),
        title.alias("title"),
        F.col("text").alias("content"),
    )
    return live.unionByName(ghosts)


def _with_md5(docs: DataFrame) -> DataFrame:
    return docs.withColumn("content_md5", C.fingerprint(F.col("content")))


def _states(spark, sf) -> DataFrame:
    current = _with_md5(documents_corpus(spark, sf)).select("path", "content_md5")
    return C.classify(current, _with_md5(_previous(spark, sf)).select("path", "content_md5"))


def change_states(spark, sf):
    return _states(spark, sf).select("path", "state")


def change_counts(spark, sf):
    return C.change_counts(_states(spark, sf))


def removed_paths(spark, sf):
    return C.removed_paths(documents_corpus(spark, sf), _previous(spark, sf))


def upsert_docs(spark, sf):
    columns = ("path", "title", "content_md5")
    states = _states(spark, sf)
    current = _with_md5(documents_corpus(spark, sf)).select(*columns)
    old = _with_md5(_previous(spark, sf)).select(*columns)
    new = C.select_paths(current, C.changed(states))
    return C.upsert(old, new, states.where("state = 'REMOVED'"))


def keyword_filter(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic = 1").select("doc_id")
    docs = documents_corpus(spark, sf).select("doc_id", "path")
    paths = docs.join(labels, "doc_id", "left_semi").select("path")
    return C.select_paths(docs, paths)


def manifest_roundtrip(spark, sf):
    return documents_index(spark, sf).manifest()


def index_roundtrip(spark, sf):
    postings = documents_index(spark, sf).postings()
    return postings.select(
        "field", "term", "doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("tf", "dl", "dl_q")]
    )


def sync_full(spark, sf):
    """Sync to an earlier state, then to the present one; the statistics must
    be those of a fresh build."""
    store = IndexStore(spark, work_folder(spark))
    sync(store, spread(_previous(spark, sf), "path"))
    sync(store, _corpus(spark, sf))
    return store.terms().select("field", "term", "df", "ttf")


def stream_ingest(spark, sf):
    """The earlier state and the changes to the present one as two batches."""
    folder = work_folder(spark)
    previous = _previous(spark, sf).select("path", F.col("content").alias("text"), F.lit(1).alias("ts"), F.lit(False).alias("deleted"))
    current = documents_corpus(spark, sf).select("path", F.col("content").alias("text"))
    gone = C.removed_paths(current, previous).select("path", F.lit(None).cast("string").alias("text"), F.lit(True).alias("deleted"))
    feed = current.withColumn("deleted", F.lit(False)).unionByName(gone).withColumn("ts", F.lit(2))
    store = IndexStore(spark, f"{folder}/index")
    schema = "path string, text string, ts int, deleted boolean"
    for rows in (previous, feed.select(*previous.columns)):
        rows.write.mode("append").parquet(f"{folder}/feed")
        source = read_feed(spark, f"{folder}/feed", schema)
        ingest(store, source, f"{folder}/checkpoint", extractors={}).awaitTermination()
    return store.docs().select("path", "title", "content_md5")


def stream_late(spark, sf):
    """Three batches out of order: the present texts and deletions first, then older
    versions of everything, then one version between; the statistics must be those of the newest."""
    folder = work_folder(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    rows = docs.select(path.alias("path"), "text", "lang")
    gone = F.col("lang") == "fr"
    newest = rows.where("lang <> 'es'").select("path", F.when(~gone, F.col("text")).alias("text"), F.lit(5).alias("ts"), gone.alias("deleted"))
    older = rows.select("path", F.concat("text", F.lit(" older")).alias("text"), F.lit(2).alias("ts"), F.lit(False).alias("deleted"))
    between = rows.where("lang in ('es', 'fr')").select("path", "text", F.lit(3).alias("ts"), F.lit(False).alias("deleted"))
    store = IndexStore(spark, f"{folder}/index")
    for batch in (newest, older, between):
        batch.write.mode("append").parquet(f"{folder}/feed")
        source = read_feed(spark, f"{folder}/feed", "path string, text string, ts int, deleted boolean")
        ingest(store, source, f"{folder}/checkpoint", extractors={}).awaitTermination()
    return store.terms().select("field", "term", "df", "ttf")


# -- analysis -----------------------------------------------------------------


def _words(spark, sf, column) -> DataFrame:
    return _corpus(spark, sf).select("doc_id", F.posexplode_outer(column).alias("pos", "word")).where(
        F.col("word").isNotNull()
    ).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "word")


def tokens(spark, sf):
    return _words(spark, sf, tokenize(F.col("content")))


def tokens_nostop(spark, sf):
    return _words(spark, sf, drop_stop_words(tokenize(F.col("content"))))


def stems(spark, sf):
    counted = tokens(spark, sf).groupBy("word").agg(F.count("*").alias("n"))
    return counted.select("word", stem(F.col("word")).alias("stem"), "n")


def normalised_terms(spark, sf):
    return tokens(spark, sf).groupBy("word").agg(F.count("*").alias("n"))


# -- index --------------------------------------------------------------------


def _postings(spark, sf) -> DataFrame:
    return P.build_postings(_corpus(spark, sf))


def postings(spark, sf):
    return _postings(spark, sf).select(
        "field", "term", "doc_id", F.col("tf").cast("bigint").alias("tf"), F.array_join("positions", " ").alias("positions")
    )


def doc_lengths(spark, sf):
    return P.text_lengths(_corpus(spark, sf)).select("field", "doc_id", F.col("dl").cast("bigint").alias("dl"))


def length_quantised(spark, sf):
    lengths = P.text_lengths(_corpus(spark, sf))
    return lengths.select("field", "doc_id", *[F.col(c).cast("bigint").alias(c) for c in ("dl", "dl_q")])


def field_stats(spark, sf):
    stats = P.field_statistics(P.term_dictionary(_postings(spark, sf)))
    return stats.withColumn("avgdl", F.round(F.col("sum_dl") / F.col("doc_count"), 6))


def term_dictionary(spark, sf):
    return P.term_dictionary(_postings(spark, sf)).select("field", "term", "df", "ttf")


# -- ranking ------------------------------------------------------------------


def _best(spark, sf, text, model="ok", fields=None, k=10) -> DataFrame:
    searcher = Searcher(documents_index(spark, sf), model, fields)
    hits = top_k(searcher.score([Q.term(text)]), k, single_query=True)
    return hits.select(F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")


def bm25_topk(spark, sf):
    return _best(spark, sf, "Things from the nation", fields=CONTENT)


def tfidf_topk(spark, sf):
    return _best(spark, sf, "Things from the nation", "vs", CONTENT)


def bm25_multifield(spark, sf):
    return _best(spark, sf, "Things from 42")


def batch_topk(spark, sf):
    texts = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text")
    hits = top_k(Searcher(documents_index(spark, sf)).score_texts(texts), 10)
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")


def batch_topk_bounded(spark, sf):
    """The first five words of each item, without scoring what cannot be among the best."""
    words = F.array_join(F.slice(F.split("text", " "), 1, 5), " ")
    texts = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), words.alias("text"))
    hits = Searcher(documents_index(spark, sf)).top_texts(texts, 10)
    return hits.select("query_id", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score")


def batch_bool(spark, sf):
    """A query for each item: one of its first two words but not the fourth, never the
    fifth; the whole text and a phrase raise the score."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), "text", F.split("text", " ").alias("w"))

    def clause(n, parent, occur, kind, text, boost=1.0):
        facts = {"clause_id": F.lit(n), "parent_id": F.lit(parent).cast("int"), "occur": F.lit(occur), "kind": F.lit(kind), "text": text, "boost": F.lit(boost)}
        return F.struct(*[v.alias(k) for k, v in facts.items()])

    def word(i):
        return F.coalesce(F.get("w", F.lit(i)), F.lit(""))

    clauses = F.array(
        clause(9, None, "must", "group", F.lit(""), 2.0),
        clause(0, 9, "should", "term", word(0)),
        clause(1, 9, "should", "term", word(1)),
        clause(3, 9, "must_not", "term", word(3)),
        clause(2, None, "must_not", "term", word(4)),
        clause(4, None, "should", "term", F.col("text"), 0.5),
        clause(5, None, "should", "phrase", F.concat_ws(" ", word(0), word(1))),
    )
    table = items.select("query_id", F.inline(clauses))
    return score_clauses(Searcher(documents_index(spark, sf), fields=CONTENT), table)


def fuzzy_batch(spark, sf):
    """Fuzzy clauses of every item in one plan: its first word with two edits, its second with one."""
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.split("text", " ").alias("w"))
    word = F.posexplode(F.slice("w", 1, 2)).alias("clause_id", "text")
    table = items.select("query_id", word).select("*", F.lit("fuzzy").alias("kind"), (2 - F.col("clause_id")).alias("max_edits"))
    return score_clauses(Searcher(documents_index(spark, sf), fields=CONTENT), table)


def ranked_results(spark, sf):
    found = Searcher(pages_index(spark, sf)).search([Q.term("tion html from")], k=20)
    # The address stands behind the page's number; a page without one has the number only.
    has_url, url = F.contains("path", F.lit("/")), F.substr("path", F.instr("path", "/") + 1)
    file_name = F.when(has_url, F.col("file_name")).alias("file_name")
    return found.select(F.col("rank").cast("bigint").alias("rank"), "score", file_name, "display_title", F.when(has_url, url).alias("path"))


def stored_fields(spark, sf):
    found = Searcher(documents_index(spark, sf), fields=CONTENT).search([Q.term("thing")])
    return found.select(F.col("rank").cast("bigint").alias("rank"), "doc_id", "path", "title")


def _matches(*clauses, fields=None):
    def run(spark, sf):
        return Searcher(documents_index(spark, sf), fields=fields).score(list(clauses)).select("doc_id", "score")

    return run


def exact_path(spark, sf):
    docs = documents_index(spark, sf).docs().select("doc_id", "path", "title")
    return docs.join(docs.agg(F.min("path").alias("path")), "path", "left_semi").select("doc_id", "path", "title")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = (
        scan_ext_filter, scan_tree, sync_stamps, route_by_type, plain_docs, html_text, extractor_routes, content_md5,
        change_states, change_counts, removed_paths, upsert_docs, keyword_filter,
        manifest_roundtrip, index_roundtrip, sync_full, stream_ingest, stream_late,
        tokens, tokens_nostop, stems, normalised_terms,
        postings, doc_lengths, length_quantised, field_stats, term_dictionary,
        bm25_topk, tfidf_topk, bm25_multifield, batch_topk, batch_topk_bounded, batch_bool, fuzzy_batch, ranked_results, stored_fields, exact_path,
    )
    return {f.__name__: f for f in named} | {
        "no_hits": _matches(Q.term("zzzznothere")),
        "bool_should": _matches(Q.term("thing"), Q.term("nation")),
        "bool_must": _matches(Q.term("thing", occur="must"), Q.term("from", occur="must"), Q.term("re")),
        "bool_must_not": _matches(Q.term("thing", occur="must"), Q.term("from", occur="must_not")),
        "bool_nested": _matches(
            Q.term("thing"),
            Q.group(
                Q.term("from", occur="must"),
                Q.term("re", occur="must"),
                Q.term("ed", occur="must_not"),
                boost=2.0,
            ),
            Q.term("er", occur="must_not"),
        ),
        "repeated_term": _matches(Q.term("thing from thing")),
        "boost": _matches(Q.term("thing", boost=2.5), Q.term("from", boost=0.5)),
        "phrase": _matches(Q.phrase("re ed"), fields=CONTENT),
        "phrase_gap": _matches(Q.phrase("er of re"), fields=CONTENT),
        "phrase_slop": _matches(Q.phrase("from ed", slop=3), fields=CONTENT),
        "phrase_slop3": _matches(Q.phrase("from ed from", slop=6), fields=CONTENT),
        "prefix": _matches(Q.prefix("tion")),
        "wildcard": _matches(Q.wildcard("Th?n*ed", boost=1.5)),
        "regexp": _matches(Q.regexp("th(re|an)+ing?")),
        "term_range": _matches(Q.term_range("thing", "thou", include_upper=False)),
        "constant_score": _matches(Q.prefix("4", boost=3.0)),
        "fuzzy": _matches(Q.fuzzy("thingre")),
        "match_all": _matches(Q.match_all()),
    }
