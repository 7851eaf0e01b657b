"""Boolean queries as rows of a table, any number of them in one plan.

A clause is a row; a group's clauses name it as their parent.  Leaves give
rows ``query_id, clause_id, doc_id, score``.  From the deepest level up, one
aggregation by (query, group, document) decides which groups hold, so the plan
grows with the depth of the deepest query and not with the number of queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.analysis import analyze_column
from wordloom.operators import fuzzy as FZ
from wordloom.operators import phrases as PH
from wordloom.operators.clauses import OCCURS
from wordloom.operators.scoring import SCORE_DIGITS, term_score
from wordloom.plans import search as S
from wordloom.plans.search import Searcher

KINDS = ("term", "phrase", "prefix", "fuzzy", "all", "group")
DEFAULTS = {
    "parent_id": "cast(null as bigint)",
    "occur": "'should'",
    "text": "''",
    "field": "cast(null as string)",
    "boost": "1.0D",
    "slop": "0",
    "max_edits": "2",
}
# No word of a fuzzy clause has more keys.
FUZZY_KEYS = 1 + FZ.PREFIX * (FZ.PREFIX + 1) // 2
# The parent of clauses that are in no group.
ROOT = -(1 << 63)


def score_clauses(searcher: Searcher, clauses: DataFrame) -> DataFrame:
    """``query_id, doc_id, score`` of every document that matches a query.

    ``clauses``: ``query_id, clause_id, kind`` and, where they differ from the
    defaults, ``parent_id, occur, text, field, boost, slop, max_edits``.  Kinds
    are term, phrase, prefix, fuzzy, all and group; clauses mean what they mean
    in ``operators.clauses``.  A clause without a term left after analysis is
    gone, a required one too, and so is a group without clauses.
    """
    return _Batch(searcher, clauses).score()


class _Batch:
    def __init__(self, searcher: Searcher, clauses: DataFrame):
        self.searcher, self.spark = searcher, searcher.spark
        for name, default in DEFAULTS.items():
            value = F.coalesce(F.col(name), F.expr(default)) if name in clauses.columns else F.expr(default)
            clauses = clauses.withColumn(name, value)
        clauses = clauses.select(
            "query_id",
            F.col("clause_id").cast("bigint").alias("clause_id"),
            F.coalesce(F.col("parent_id").cast("bigint"), F.lit(ROOT)).alias("parent"),
            "kind",
            "occur",
            "text",
            "field",
            F.col("boost").cast("double").alias("boost"),
            F.col("slop").cast("int").alias("slop"),
            F.col("max_edits").cast("int").alias("max_edits"),
        )
        n = clauses.count()
        self.small = n * len(searcher.fields) <= S.BROADCAST_ROWS
        self.few_keys = n * len(searcher.fields) * FUZZY_KEYS <= S.BROADCAST_ROWS
        if self.small:
            # The clauses are read once; all that is made of them is a plan over local rows.
            clauses = self.spark.createDataFrame(clauses.toArrow(), clauses.schema)
        self.levels = self._levels(clauses, n)

    def _sized(self, table: DataFrame) -> DataFrame:
        return F.broadcast(table) if self.small else table

    def _levels(self, clauses: DataFrame, n: int) -> list[DataFrame]:
        """Clauses by depth, with the product of the boosts on their way."""
        wrong = clauses.where(
            ~F.col("kind").isin(*KINDS) | ~F.col("occur").isin(*OCCURS) | (F.col("boost") < 0) | (F.col("slop") < 0) | ~F.col("max_edits").between(0, FZ.MAX_EDITS)
        ).first()
        if wrong:
            raise ValueError(f"a clause table cannot hold {wrong.asDict()}")
        levels, level, found = [], clauses.where(F.col("parent") == ROOT), 0
        while (size := level.count()) > 0:
            levels.append(level)
            found += size
            groups = level.where("kind = 'group'").select("query_id", F.col("clause_id").alias("parent"), F.col("boost").alias("_outer"))
            level = clauses.join(self._sized(groups), ["query_id", "parent"]).withColumn("boost", F.col("boost") * F.col("_outer")).drop("_outer")
        if found != n:
            raise ValueError(f"{n - found} clauses have a parent that is no group of their query, or an id used twice")
        return levels

    # -- leaves --------------------------------------------------------------

    def _fields(self) -> Column:
        return F.when(F.col("field").isNotNull(), F.array("field")).otherwise(F.array(*[F.lit(f) for f in self.searcher.fields]))

    def _words(self, level: DataFrame) -> DataFrame:
        """``idx, shift, term`` of the clauses with text, by field."""
        words = level.where("kind in ('term', 'phrase')").select(
            "*", F.posexplode(F.filter(F.transform(analyze_column("text"), lambda t, i: F.struct(i.alias("pos"), t.alias("term"))), lambda w: w["term"].isNotNull())).alias("idx", "w")
        )
        of = Window.partitionBy("query_id", "clause_id")
        words = words.withColumns({"n_terms": F.count("*").over(of), "repeats": F.size(F.collect_set("w.term").over(of)) < F.count("*").over(of), "shift": F.col("w.pos") - F.min("w.pos").over(of)})
        return words.select(
            "query_id", "clause_id", "parent", "occur", "kind", "boost", "slop", "idx", "n_terms", "repeats", F.col("shift").cast("int").alias("shift"),
            F.col("w.term").alias("term"), self.searcher.store.bucket(F.col("w.term")).alias("bucket"), F.explode(self._fields()).alias("field"),
        )

    def _held(self, postings: DataFrame, lookups: DataFrame, *columns: str) -> DataFrame:
        if self.small:
            return self.searcher._by_document(postings, lookups, *columns)
        return postings.select("field", "term", "bucket", "doc_id", *columns)

    def _leaf_hits(self, level: DataFrame, words: DataFrame) -> DataFrame:
        """``query_id, parent, clause_id, occur, doc_id, score``; a clause may
        have several rows for a document, which add up."""
        s = self.searcher
        keys = ["query_id", "parent", "clause_id", "occur"]
        terms = s.store.terms(s.at).select("field", "term", "bucket", "df")
        postings = s.store.postings(s.at)
        single = words.where("kind = 'term' or n_terms = 1")
        weighted = single.groupBy(*keys, "field", "term", "bucket").agg(F.sum("boost").alias("weight"))
        weighted = s._with_idf(self._sized(weighted).join(terms, ["field", "term", "bucket"]))
        score = F.col("weight") * term_score(s.model, F.col("idf"), F.col("tf"), F.col("dl_q"), F.col("avgdl"))
        held = self._held(postings, weighted, "tf", "dl_q").join(self._sized(weighted), ["field", "term", "bucket"])
        parts = [held.select(*keys, "doc_id", score.alias("score"))]

        several = words.where("kind = 'phrase' and n_terms > 1")
        sloppy = F.col("slop") > 0
        longest = several.agg(
            F.max("n_terms"), F.max(F.when(sloppy & ~F.col("repeats"), F.col("n_terms"))), F.max(sloppy & F.col("repeats"))
        ).first()
        if longest[0]:
            parts.append(self._phrase_hits(several, terms, postings, keys, longest[1], longest[2]))

        kinds = {r["kind"] for r in level.select("kind").distinct().collect()}  # of KINDS
        if "prefix" in kinds:
            wanted = level.where("kind = 'prefix'").select(*keys, "boost", F.col("field").alias("_field"), F.lower("text").alias("start"))
            of_field = F.col("_field").isNull() | (F.col("_field") == F.col("field"))
            begins = F.startswith(F.col("term"), F.col("start")) & F.col("field").isin(*s.fields) & of_field
            found = terms.join(F.broadcast(wanted), begins).select(*keys, "boost", "field", "term", "bucket")
            # The boost once for each field, however many of its terms begin so.
            held = postings.select("field", "term", "bucket", "doc_id").join(found, ["field", "term", "bucket"])
            parts.append(held.groupBy(*keys, "field", "doc_id").agg(F.max("boost").alias("score")).drop("field"))
        if "fuzzy" in kinds:
            # Clauses of one word, number of edits and field have the same terms, which are found and scored once.
            of = F.struct(F.lower("text").alias("word"), "max_edits", F.coalesce("field", F.lit("")).alias("field"))
            asked = level.where("kind = 'fuzzy'").withColumn("clause", of)
            words = asked.select("clause", "clause.word", "max_edits", F.explode(self._fields()).alias("field")).distinct()
            near = s._with_idf(FZ.expand(terms, words, self.few_keys)).select("clause", "field", "term", "bucket", "closeness", "idf", "avgdl")
            # How many terms are near is known when the job runs: few of them are read once and go to every task.
            rows = near.limit(S.BROADCAST_ROWS + 1).toArrow()
            held = postings.select("field", "term", "bucket", "doc_id", "tf", "dl_q")
            if rows.num_rows <= S.BROADCAST_ROWS:
                near = F.broadcast(self.spark.createDataFrame(rows, near.schema))
                held = s._by_document(postings, near, "tf", "dl_q")
            score = F.col("closeness") * term_score(s.model, F.col("idf"), F.col("tf"), F.col("dl_q"), F.col("avgdl"))
            sums = held.join(near, ["field", "term", "bucket"]).groupBy("clause", "doc_id").agg(F.sum(score).alias("score"))
            scored = sums.join(self._sized(asked.select("clause", *keys, "boost")), "clause")
            parts.append(scored.select(*keys, "doc_id", (F.col("boost") * F.col("score")).alias("score")))
        if "all" in kinds:
            every = level.where("kind = 'all'").select(*keys, F.col("boost").alias("score"))
            parts.append(s.store.docs(s.at).select("doc_id").join(F.broadcast(every)).select(*keys, "doc_id", "score"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _phrase_hits(self, words, terms, postings, keys, longest: int | None, repeats: bool) -> DataFrame:
        s = self.searcher
        of = ["query_id", "clause_id", "field"]
        known = s._with_idf(self._sized(words).join(terms, ["field", "term", "bucket"]))
        window = Window.partitionBy(*of)
        rarest = F.row_number().over(window.orderBy("df", "idx")) == 1
        known = known.withColumns({"found": F.count("*").over(window), "idfs": F.sum("idf").over(window), "rarest": rarest})
        known = known.where("found = n_terms").withColumn("phrase_id", F.struct("query_id", "clause_id"))
        asked = known.select("phrase_id", "field", "term", "bucket", "idx", "shift", F.col("n_terms").cast("int").alias("n_terms"), "slop", "rarest", "repeats")
        postings = self._held(postings, asked, "dl_q", "positions")
        parts = [PH.exact_frequency(PH.phrase_candidates(postings, asked.where("slop = 0"), False))]
        if longest:
            parts.append(PH.sloppy_frequency(PH.phrase_candidates(postings, asked.where("slop > 0 and not repeats"), False), longest))
        if repeats:
            parts.append(PH.repeated_frequency(PH.phrase_candidates(postings, asked.where("slop > 0 and repeats"), False)))
        freq = parts[0]
        for part in parts[1:]:
            freq = freq.unionByName(part)
        facts = known.where("rarest").select("phrase_id", *keys, "field", "boost", "idfs", "avgdl")
        score = F.col("boost") * term_score(s.model, F.col("idfs"), F.col("freq"), F.col("dl_q"), F.col("avgdl"))
        return freq.join(self._sized(facts), ["phrase_id", "field"]).select(*keys, "doc_id", score.alias("score"))

    # -- groups --------------------------------------------------------------

    def score(self) -> DataFrame:
        results, alive = None, None
        for level in reversed(self.levels):
            words = self._words(level)
            if self.small:
                words = self.spark.createDataFrame(words.toArrow(), words.schema)
            # Clauses of this level that count: leaves with a term, groups with a clause that counts.
            told = words.select("query_id", "clause_id").distinct()
            counts = level.where("kind in ('prefix', 'fuzzy', 'all')").select("query_id", "clause_id").unionByName(told)
            if alive is not None:
                counts = counts.unionByName(alive)
            here = level.join(self._sized(counts), ["query_id", "clause_id"], "left_semi")
            hits = self._leaf_hits(level, words)
            if results is not None:
                groups = here.where("kind = 'group'").select("query_id", "clause_id", "parent", "occur")
                hits = hits.unionByName(results.join(self._sized(groups), ["query_id", "clause_id"]).select(*hits.columns))
            needs = here.groupBy("query_id", "parent").agg(F.count_if(F.col("occur") == "must").alias("n_must"))
            results = self._hold(hits, needs)
            alive = needs.select("query_id", F.col("parent").alias("clause_id"))
        if results is None:
            return self.searcher._nothing()
        return results.select("query_id", "doc_id", F.round("score", SCORE_DIGITS).alias("score"))

    def _hold(self, hits: DataFrame, needs: DataFrame) -> DataFrame:
        """``query_id, clause_id, doc_id, score`` of groups and the documents they hold for."""

        def is_(occur: str) -> Column:
            return F.col("occur") == occur

        # By clause first: a clause with several rows for a document is one that matches.
        clauses = hits.groupBy("query_id", "parent", "clause_id", "occur", "doc_id").agg(F.sum("score").alias("score"))
        table = clauses.groupBy("query_id", "parent", "doc_id").agg(
            F.count_if(is_("must")).alias("musts"),
            F.count_if(is_("should")).alias("shoulds"),
            F.count_if(is_("must_not")).alias("excluded"),
            F.coalesce(F.sum(F.when(~is_("must_not"), F.col("score"))), F.lit(0.0)).alias("score"),
        )
        matched = (F.col("excluded") == 0) & (F.col("musts") == F.col("n_must")) & ((F.col("n_must") > 0) | (F.col("shoulds") > 0))
        kept = table.join(self._sized(needs), ["query_id", "parent"]).where(matched)
        return kept.select("query_id", F.col("parent").alias("clause_id"), "doc_id", "score")
