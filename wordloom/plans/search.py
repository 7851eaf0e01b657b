"""From queries to ranked documents, as one Spark plan.

The clauses of the queries are few and known when the plan is made.  Each
clause gives rows ``query_id, slot, doc_id, score``; one aggregation per
(query, document) turns the slots into columns, and the boolean structure of
the query is an expression over them, nested groups included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.analysis import analyze_column
from wordloom.functions.edits import edits_up_to
from wordloom.operators import dictionary as D
from wordloom.operators import phrases as PH
from wordloom.operators import topk as TK
from wordloom.operators.clauses import Clause, Query
from wordloom.operators.scoring import SCORE_DIGITS, idf, model_key, term_score
from wordloom.plans.store import Commit, IndexStore, local_rows

# A side of a join is handed to every task only if it is known to have at most
# this many rows (some tens of megabytes); a larger one is joined by shuffle,
# where adaptive execution splits the partitions of frequent terms.
BROADCAST_ROWS = 500_000

# Required terms narrow the others down if those are this much more frequent.
ANCHOR_GAIN = 4

# Up to this many results are sorted in one task.
ONE_TASK_ROWS = 10_000

# Up to this many terms are written into the plan as literals, which lets the
# scan skip folders and row groups.
LITERAL_TERMS = 2_000

# Documents whose postings one task scores for all queries of a table.
TASK_DOCUMENTS = 4_000

# Postings for each wanted result that give a query its first floor.
FIRST_ROWS = 20

# More than sums of the same scores in another order can differ by, and than
# rounding to SCORE_DIGITS can.
ROUNDING = 1e-5

CONSTANT_KINDS = ("prefix", "wildcard", "regexp", "range")


@dataclass
class _Compiled:
    """Work lists gathered from all clauses of all queries."""

    terms: Counter = field(default_factory=Counter)  # (query, slot, field, term) -> weight
    phrases: list = field(default_factory=list)  # (query, slot, field, boost, slop, tokens)
    fuzzies: list = field(default_factory=list)  # (query, slot, field, boost, clause)
    constants: list = field(default_factory=list)  # (query, slot, field, boost, clause)
    alls: list = field(default_factory=list)  # (query, slot, boost)
    trees: dict = field(default_factory=dict)  # query -> (match, score)
    required: dict = field(default_factory=dict)  # query -> slots of its required terms
    n_sums: int = 0
    n_maxes: int = 0


class _QueryCompiler:
    """Slots and boolean expression of one query."""

    def __init__(self, query_id: int, fields: Sequence[str], tokens: Mapping[int, list], out: _Compiled):
        self.query_id, self.fields, self.tokens, self.out = query_id, fields, tokens, out
        self.sums = self.maxes = 0

    def _slot(self, kind: str) -> str:
        n = getattr(self, kind)
        setattr(self, kind, n + 1)
        total = f"n_{kind}"
        setattr(self.out, total, max(getattr(self.out, total), n + 1))
        return f"{kind}_{n}"

    def group(
        self, clauses: Sequence[Clause], boost: float, outermost: bool = False
    ) -> tuple[Column, Column] | None:
        """(matched, score) of a group; None if nothing of it is left.

        Optional clauses with additive scores share one slot: whether any of
        them matched and the sum of their scores is all the group asks for.
        """
        shared: list[str] = []
        parts: dict[str, list] = {"must": [], "should": [], "must_not": []}
        for clause in clauses:
            result = self.clause(clause, boost, shared if clause.occur == "should" else None)
            if result is not None:
                parts[clause.occur].append(result)
                if outermost and clause.occur == "must" and clause.kind == "term":
                    self.out.required.setdefault(self.query_id, []).append(f"sums_{self.sums - 1}")
        if shared:
            parts["should"].append(_slot_result(shared))
        scoring = parts["must"] + parts["should"]
        if not scoring and not parts["must_not"]:
            return None
        if parts["must"]:
            matched = _all(m for m, _ in parts["must"])
        else:
            matched = _any(m for m, _ in parts["should"])
        for excluded, _ in parts["must_not"]:
            matched = matched & ~excluded
        score = F.lit(0.0)
        for m, s in scoring:
            score = score + F.when(m, s).otherwise(F.lit(0.0))
        return matched, score

    def clause(self, clause: Clause, outer: float, shared: list[str] | None):
        boost = outer * clause.boost
        if clause.kind == "group":
            return self.group(clause.clauses, boost)
        fields = [clause.field] if clause.field else list(self.fields)
        if clause.kind == "all":
            slot = self._slot("maxes")
            self.out.alls.append((self.query_id, slot, boost))
            return _slot_result([slot])
        if clause.kind in CONSTANT_KINDS:
            slots = []
            for f in fields:
                slots.append(self._slot("maxes"))
                self.out.constants.append((self.query_id, slots[-1], f, boost, clause))
            return _slot_result(slots)

        tokens = self.tokens.get(id(clause), [])
        if clause.kind != "fuzzy" and not tokens:
            return None
        if shared is None:
            slot = self._slot("sums")
        else:
            slot = shared[0] if shared else self._slot("sums")
            if not shared:
                shared.append(slot)
        for f in fields:
            if clause.kind == "fuzzy":
                self.out.fuzzies.append((self.query_id, slot, f, boost, clause))
            elif clause.kind == "phrase" and len(tokens) > 1:
                self.out.phrases.append((self.query_id, slot, f, boost, clause.slop, tokens))
            else:
                for _, word, _ in tokens:
                    self.out.terms[(self.query_id, slot, f, word)] += boost
        return None if shared is not None else _slot_result([slot])


def _slot_result(slots: Sequence[str]) -> tuple[Column, Column]:
    score = F.lit(0.0)
    for s in slots:
        score = score + F.coalesce(F.col(s), F.lit(0.0))
    return _any(F.col(s).isNotNull() for s in slots), score


def _any(tests) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def _lookup(query_id: int, slot: str, row, weight: float) -> dict:
    """A term to look up; without an idf it has a constant score."""
    found = row.asDict()
    return {
        "query_id": query_id,
        "slot": slot,
        "field": found["field"],
        "term": found["term"],
        "bucket": found["bucket"],
        "df": found.get("df"),
        "weight": float(weight),
        "idf": found.get("idf"),
        "avgdl": found.get("avgdl"),
    }


def _split_by_anchor(lookups: list[dict], required: Mapping) -> tuple[list, list, list]:
    """(free, bound, anchors): lookups of the rarest required term of a query
    are its anchors, and its other lookups are bound to their documents.

    Only where the other terms are much more frequent, so that it pays to
    read the anchors twice, and while all anchors together are few.
    """
    by_query: dict[int, list[dict]] = {}
    for row in lookups:
        by_query.setdefault(row["query_id"], []).append(row)
    free, bound, anchors, room = [], [], [], BROADCAST_ROWS
    for query_id, rows in by_query.items():
        sizes = {
            slot: sum(r["df"] for r in rows if r["slot"] == slot) for slot in required.get(query_id, [])
        }
        slot = min(sizes, key=sizes.get) if sizes else None
        total = sum(r["df"] or 0 for r in rows)
        if slot is None or sizes[slot] > room or total < ANCHOR_GAIN * sizes[slot]:
            free += rows
            continue
        room -= sizes[slot]
        anchors += [r for r in rows if r["slot"] == slot]
        bound += [r for r in rows if r["slot"] != slot]
    return (free, bound, anchors) if anchors and bound else (lookups, [], [])


class Searcher:
    """Searches one commit of an index."""

    def __init__(self, store: IndexStore, model: str = "ok", fields: Sequence[str] | None = None):
        self.store = store
        self.spark = store.spark
        self.model = model_key(model)
        self.fields = tuple(fields or store.fields)
        self.at: Commit = store.commit()
        self._bucket_of: dict[str, int] = {}
        # One row per field of this commit: constants of every plan below.
        self.stats = {r["field"]: r for r in store.field_stats(self.at).collect()}

    # -- public -------------------------------------------------------------

    def score(self, queries: Query | Mapping[int, Query]) -> DataFrame:
        """``query_id, doc_id, score`` of every matching document."""
        if not isinstance(queries, Mapping):
            queries = {0: queries}
        work = self._compile(queries)
        hits = self._hits(work)
        slots = [f"sums_{i}" for i in range(work.n_sums)] + [f"maxes_{i}" for i in range(work.n_maxes)]
        if hits is None or not slots or not work.trees:
            return self._nothing()
        gather = [
            (F.sum if s.startswith("sums") else F.max)(F.when(F.col("slot") == s, F.col("score"))).alias(s)
            for s in slots
        ]
        table = hits.groupBy("query_id", "doc_id").agg(*gather)
        matched, score = F.lit(False), F.lit(0.0)
        for query_id, (m, s) in work.trees.items():
            of_query = F.col("query_id") == query_id
            matched = F.when(of_query, m).otherwise(matched)
            score = F.when(of_query, s).otherwise(score)
        return table.where(matched).select(
            "query_id", "doc_id", F.round(score, SCORE_DIGITS).alias("score")
        )

    def score_texts(self, queries: DataFrame) -> DataFrame:
        """Like ``score`` for a table ``query_id, text`` of any size.

        Every term of a text is an optional clause on every field.
        """
        weighted, postings, small = self._text_lookups(queries)
        if small:
            weighted = F.broadcast(weighted)
            postings = self._by_document(postings, weighted, "tf", "dl_q")
        hits = self._term_hits(postings, weighted)
        return hits.groupBy("query_id", "doc_id").agg(F.round(F.sum("score"), SCORE_DIGITS).alias("score"))

    def top_texts(self, queries: DataFrame, k: int = TK.RESULT_COUNT) -> DataFrame:
        """The k best documents of ``score_texts`` for each query, ranked.

        No document is scored that cannot be among them.  The rarest terms of
        a query, of FIRST_ROWS * k postings together, give a first floor: the
        k-th best sum they reach alone.  Terms are then ordered by frequency,
        and the last ones that together cannot add up to the floor are left
        out: a document without any of the others is below it.  The sums of
        the others give a higher floor, and only a document that the terms
        left out can lift over it is looked up in their postings, by its number.
        """
        TK.check_k(k)
        weighted, postings, small = self._text_lookups(queries)
        most = F.col("weight") * term_score(
            self.model, F.col("idf"), F.col("max_tf"), F.col("min_dl_q"), F.col("avgdl")
        )
        by = Window.partitionBy("query_id").orderBy("df", "term", "field")
        before = F.sum("df").over(by.rowsBetween(Window.unboundedPreceding, -1))
        from_here = F.sum("most").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
        terms = weighted.withColumn("most", most).withColumns(
            {"before": F.coalesce(before, F.lit(0)), "from_here": from_here}
        )
        if small:
            terms = self.spark.createDataFrame(terms.toArrow(), terms.schema)
        sized = F.broadcast if small else (lambda t: t)

        few = (F.col("before") == 0) | (F.col("before") + F.col("df") <= FIRST_ROWS * k)
        first = self._sums(postings, sized(terms.where(few)))
        terms = terms.join(sized(self._floors(first, k)), "query_id", "left")
        floor = F.coalesce("floor", F.lit(0.0)) - ROUNDING
        needed, rest = terms.where(F.col("from_here") >= floor), terms.where(F.col("from_here") < floor)
        sums = self._sums(postings, sized(needed))
        above = rest.groupBy("query_id").agg(F.max("from_here").alias("rest"), F.first("floor").alias("floor"))
        above = above.join(sized(self._floors(sums, k).withColumnRenamed("floor", "higher")), "query_id", "left")
        above = above.select("query_id", "rest", F.greatest("floor", "higher").alias("floor"))
        open_ = sums.join(sized(above), "query_id", "left").where(
            F.col("rest").isNull() | (F.col("score") + F.col("rest") >= F.col("floor") - ROUNDING)
        )
        asked = open_.select("query_id", "doc_id").join(
            sized(rest.select("query_id", "field", "term", "bucket", "weight", "idf", "avgdl")), "query_id"
        )
        more = self._term_hits(postings, asked)
        total = (
            open_.select("query_id", "doc_id", "score")
            .unionByName(more)
            .groupBy("query_id", "doc_id")
            .agg(F.round(F.sum("score"), SCORE_DIGITS).alias("score"))
        )
        return TK.top_k(total, k)

    def _sums(self, postings: DataFrame, weighted: DataFrame) -> DataFrame:
        hits = self._term_hits(postings, weighted)
        return hits.groupBy("query_id", "doc_id").agg(F.sum("score").alias("score"))

    def _floors(self, sums: DataFrame, k: int) -> DataFrame:
        """The k-th best sum of each query that has k."""
        best = TK.top_k(sums, k).groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
        return best.where(F.col("n") == k).drop("n")

    def _text_lookups(self, queries: DataFrame) -> tuple[DataFrame, DataFrame, bool]:
        """The terms of query texts with their statistics, the postings that
        can hold them, and whether the terms are few enough for every task."""
        words = F.explode_outer(analyze_column("text")).alias("term")
        counted = (
            queries.select("query_id", words)
            .where(F.col("term").isNotNull())
            .groupBy("query_id", "term")
            .agg(F.count("*").cast("double").alias("weight"))
            .withColumn("bucket", self.store.bucket(F.col("term")))
        )
        # The size of the query table decides the plan.  These are two passes
        # over the queries, never over the index.
        n_lookups = counted.count() * len(self.fields)
        distinct = counted.select("term", "bucket").distinct().limit(LITERAL_TERMS + 1).collect()
        terms, postings = self.store.terms(self.at), self.store.postings(self.at)
        if len(distinct) <= LITERAL_TERMS:
            self._bucket_of.update({r["term"]: r["bucket"] for r in distinct})
            words = [r["term"] for r in distinct]
            terms, postings = (self._only(t, self.fields, words) for t in (terms, postings))

        fields = F.explode(F.array(*[F.lit(f) for f in self.fields])).alias("field")
        lookups = counted.select("query_id", "term", "weight", "bucket", fields)
        small = n_lookups <= BROADCAST_ROWS
        lookups = F.broadcast(lookups) if small else lookups
        terms = terms.select("field", "term", "bucket", "df", "max_tf", "min_dl_q")
        return self._with_idf(lookups.join(terms, ["field", "term", "bucket"])), postings, small

    def search(self, queries: Query | Mapping[int, Query], k: int = TK.RESULT_COUNT) -> DataFrame:
        """Ranked results with their stored fields, best first."""
        TK.check_k(k)
        single = not isinstance(queries, Mapping) or len(queries) == 1
        hits = TK.top_k(self.score(queries), k, single)
        n = k if single else k * len(queries)
        found = self.fetch(hits, n)
        if n <= ONE_TASK_ROWS:
            return found.repartition(1).sortWithinPartitions("query_id", "rank")
        return found.orderBy("query_id", "rank")

    def search_texts(self, queries: DataFrame, k: int = TK.RESULT_COUNT) -> DataFrame:
        return self.fetch(self.top_texts(queries, k), k * queries.count())

    def fetch(self, hits: DataFrame, n: int) -> DataFrame:
        """Stored fields of at most n hits; only their folders are read."""
        hits = hits.withColumn("shard", self.store.shard(F.col("doc_id")))
        if n <= BROADCAST_ROWS:
            hits = F.broadcast(hits)
        docs = self.store.docs(self.at).select("doc_id", "shard", "path", "title")
        return TK.with_stored_fields(hits, docs)

    # -- compilation --------------------------------------------------------

    def _nothing(self) -> DataFrame:
        return self.spark.createDataFrame([], "query_id int, doc_id bigint, score double")

    def _compile(self, queries: Mapping[int, Query]) -> _Compiled:
        tokens = self._analyze_clauses(queries)
        work = _Compiled()
        for query_id, clauses in queries.items():
            tree = _QueryCompiler(query_id, self.fields, tokens, work).group(clauses, 1.0, True)
            if tree is not None:
                work.trees[query_id] = tree
        return work

    def _analyze_clauses(self, queries: Mapping[int, Query]) -> dict[int, list]:
        """Tokens ``(position, term, bucket)`` of the clauses with text.

        The texts come from the caller, so collecting their terms is bounded
        by what was typed.  It makes the terms literals of the plan, which is
        what lets the scan skip folders and row groups.
        """
        leaves: list[Clause] = []

        def walk(clauses):
            for c in clauses:
                if c.kind == "group":
                    walk(c.clauses)
                elif c.kind in ("term", "phrase"):
                    leaves.append(c)

        for clauses in queries.values():
            walk(clauses)
        if not leaves:
            return {}
        texts = sorted({c.text for c in leaves})
        rows = local_rows(self.spark, [{"text": t} for t in texts], "text string")
        found = (
            rows.select("text", F.posexplode_outer(analyze_column("text")).alias("pos", "term"))
            .where(F.col("term").isNotNull())
            .withColumn("bucket", self.store.bucket(F.col("term")))
            .collect()
        )
        by_text: dict[str, list] = {}
        for r in found:
            by_text.setdefault(r["text"], []).append((r["pos"], r["term"], r["bucket"]))
            self._bucket_of[r["term"]] = r["bucket"]
        return {id(c): sorted(by_text.get(c.text, [])) for c in leaves}

    # -- hits ---------------------------------------------------------------

    def _hits(self, work: _Compiled) -> DataFrame | None:
        statistics = self._statistics(work)
        lookups = self._term_lookups(work.terms, statistics)
        if work.fuzzies:
            lookups += self._fuzzy_lookups(work.fuzzies)
        parts = []
        if work.constants:
            few, expanded = self._constant_lookups(work.constants)
            lookups += few
            if expanded is not None:
                parts.append(self._hits_of_many(expanded))
        if lookups:
            free, bound, anchors = _split_by_anchor(lookups, work.required)
            if free:
                parts.append(self._hits_of_lookups(free))
            if anchors:
                anchored = self._hits_of_lookups(anchors)
                holders = F.broadcast(anchored.select("query_id", "doc_id"))
                others = self._hits_of_lookups(bound)
                parts += [anchored, others.join(holders, ["query_id", "doc_id"], "left_semi").select(anchored.columns)]
        if work.phrases:
            parts.append(self._hits_of_phrases(work.phrases, statistics))
        if work.alls:
            parts.append(self._hits_of_all(work.alls))
        parts = [p for p in parts if p is not None]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _of_field(self, column: str) -> Column:
        """A statistic of the row's field, as a constant per field."""
        value = F.lit(None).cast("double")
        for name, row in self.stats.items():
            value = F.when(F.col("field") == name, F.lit(float(row[column]))).otherwise(value)
        return value

    def _with_idf(self, lookups: DataFrame) -> DataFrame:
        return lookups.withColumns(
            {
                "idf": idf(self.model, F.col("df"), self._of_field("doc_count")),
                "avgdl": self._of_field("avgdl"),
            }
        )

    def _term_hits(self, postings: DataFrame, weighted: DataFrame) -> DataFrame:
        """Scores of terms, of one document each if the lookups name it; a
        lookup without an idf scores its weight."""
        score = F.col("weight") * F.when(F.col("idf").isNull(), F.lit(1.0)).otherwise(
            term_score(self.model, F.col("idf"), F.col("tf"), F.col("dl_q"), F.col("avgdl"))
        )
        slot = ["slot"] if "slot" in weighted.columns else []
        document = ["doc_id"] if "doc_id" in weighted.columns else []
        return (
            postings.select("field", "term", "bucket", "doc_id", "tf", "dl_q")
            .join(weighted, ["field", "term", "bucket", *document])
            .select("query_id", *slot, "doc_id", score.alias("score"))
        )

    def _by_document(self, postings: DataFrame, lookups: DataFrame, *columns: str) -> DataFrame:
        """The postings of the terms looked up, each once, dealt by document.

        What is grouped by document and query after that needs no other
        shuffle, so what travels does not grow with the number of queries.
        ``lookups`` are few enough for every task.
        """
        terms = ["field", "term", "bucket"]
        wanted = F.broadcast(lookups.select(*terms).distinct())
        documents = max([r["doc_count"] for r in self.stats.values()], default=0)
        cores = self.spark.sparkContext.defaultParallelism
        tasks = max(1, min(cores, documents // 500), documents // TASK_DOCUMENTS)
        held = postings.select(*terms, "doc_id", *columns).join(wanted, terms, "left_semi")
        return held.repartition(int(tasks), "doc_id")

    def _only(self, table: DataFrame, fields, words) -> DataFrame:
        """Rows of some terms: folder and row-group pruning by literals."""
        buckets = sorted({self._bucket_of[w] for w in words})
        return table.where(
            F.col("bucket").isin(*buckets)
            & F.col("field").isin(*sorted(set(fields)))
            & F.col("term").isin(*sorted(set(words)))
        )

    def _statistics(self, work: _Compiled) -> dict:
        """(field, term) -> df, idf, avgdl of the terms that were typed."""
        fields = [f for _, _, f, _ in work.terms] + [f for _, _, f, _, _, _ in work.phrases]
        words = [w for _, _, _, w in work.terms]
        words += [w for *_, tokens in work.phrases for _, w, _ in tokens]
        if not words:
            return {}
        dictionary = self._only(self.store.terms(self.at), fields, words)
        rows = self._with_idf(dictionary).select("field", "term", "bucket", "df", "idf", "avgdl").collect()
        return {(r["field"], r["term"]): r for r in rows}

    def _term_lookups(self, terms: Counter, statistics: dict) -> list[dict]:
        return [
            _lookup(q, slot, statistics[f, w], weight)
            for (q, slot, f, w), weight in terms.items()
            if (f, w) in statistics
        ]

    def _fuzzy_lookups(self, fuzzies: list) -> list[dict]:
        """Every term within the edits, per clause and field."""
        dictionary = self.store.terms(self.at).select("field", "term", "bucket", "df")
        length = F.length("term")
        expanded = None
        for n, (_, _, f, _, clause) in enumerate(fuzzies):
            word = clause.text.lower()
            closeness = 1.0 - F.col("edits") / F.least(F.lit(len(word)), length)
            near = (
                dictionary.where(
                    (F.col("field") == f)
                    & length.between(max(1, len(word) - clause.max_edits), len(word) + clause.max_edits)
                )
                .withColumn("edits", edits_up_to(F.col("term"), word, clause.max_edits))
                .where("edits is not null")
                .withColumn("closeness", F.when(F.col("edits") == 0, 1.0).otherwise(closeness))
                .where("closeness > 0")
                .withColumn("clause", F.lit(n))
            )
            expanded = near if expanded is None else expanded.unionByName(near)
        # The expansions of a clause share the largest document frequency.
        shared = F.max("df").over(Window.partitionBy("clause"))
        rows = self._with_idf(expanded.withColumn("df", shared)).collect()
        out = []
        for r in rows:
            query_id, slot, _, boost, _ = fuzzies[r["clause"]]
            self._bucket_of[r["term"]] = r["bucket"]
            out.append(_lookup(query_id, slot, r, boost * r["closeness"]))
        return out

    def _constant_lookups(self, constants: list) -> tuple[list[dict], DataFrame | None]:
        """Terms of prefix, wildcard, regexp and range clauses.

        One pass over the dictionary for all clauses.  A few terms come back
        as rows for the plan, any larger number as a table.
        """
        matches, tests = [], []
        for n, (_, _, f, _, clause) in enumerate(constants):
            test = (F.col("field") == f) & D.term_test(clause, F.col("term"))
            tests.append(test)
            matches.append(F.when(test, F.lit(n)))
        expanded = (
            self.store.terms(self.at)
            .where(_any(tests))
            .select("field", "term", "bucket", F.explode_outer(F.array_compact(F.array(*matches))).alias("clause"))
        )
        rows = expanded.limit(LITERAL_TERMS + 1).collect()
        if len(rows) > LITERAL_TERMS:
            facts = [
                {"clause": n, "query_id": q, "slot": slot, "score": float(boost)}
                for n, (q, slot, _, boost, _) in enumerate(constants)
            ]
            facts = local_rows(self.spark, facts, "clause int, query_id int, slot string, score double")
            return [], expanded.join(F.broadcast(facts), "clause").drop("clause")
        out = []
        for r in rows:
            query_id, slot, _, boost, _ = constants[r["clause"]]
            self._bucket_of[r["term"]] = r["bucket"]
            out.append(_lookup(query_id, slot, r, boost))
        return out, None

    def _hits_of_lookups(self, lookups: list[dict]) -> DataFrame:
        """The index lookup: terms, folders and weights are literals."""
        weighted = local_rows(
            self.spark,
            lookups,
            "query_id int, slot string, field string, term string, bucket int, "
            "weight double, idf double, avgdl double",
        )
        postings = self._only(
            self.store.postings(self.at), [r["field"] for r in lookups], [r["term"] for r in lookups]
        )
        small = len(lookups) <= BROADCAST_ROWS
        return self._term_hits(postings, F.broadcast(weighted) if small else weighted)

    def _hits_of_many(self, expanded: DataFrame) -> DataFrame:
        """Constant scores for any number of terms."""
        if expanded.count() <= BROADCAST_ROWS:
            expanded = F.broadcast(expanded)
        return (
            self.store.postings(self.at)
            .select("field", "term", "bucket", "doc_id")
            .join(expanded, ["field", "term", "bucket"])
            .select("query_id", "slot", "doc_id", "score")
        )

    def _hits_of_phrases(self, phrases: list, known: dict) -> DataFrame | None:
        rows, info = [], []
        for phrase_id, (query_id, slot, f, boost, slop, tokens) in enumerate(phrases):
            stats = [known.get((f, word)) for _, word, _ in tokens]
            if None in stats:
                continue  # a term that no document has
            rarest = min(range(len(tokens)), key=lambda i: stats[i]["df"])
            for idx, (pos, word, bucket) in enumerate(tokens):
                rows.append(
                    {
                        "phrase_id": phrase_id,
                        "field": f,
                        "term": word,
                        "bucket": bucket,
                        "idx": idx,
                        "shift": pos - tokens[0][0],
                        "n_terms": len(tokens),
                        "slop": slop,
                        "rarest": idx == rarest,
                    }
                )
            info.append(
                {
                    "phrase_id": phrase_id,
                    "query_id": query_id,
                    "slot": slot,
                    "weight": float(boost),
                    "idf": sum(s["idf"] for s in stats),
                    "avgdl": stats[0]["avgdl"],
                }
            )
        if not rows:
            return None
        postings = self._only(
            self.store.postings(self.at), [r["field"] for r in rows], [r["term"] for r in rows]
        )
        schema = (
            "phrase_id int, field string, term string, bucket int, idx int, shift int, "
            "n_terms int, slop int, rarest boolean"
        )
        frequencies = []
        terms = {}
        for r in rows:
            terms.setdefault(r["phrase_id"], set()).add(r["term"])
        for sloppy, repeats in ((False, None), (True, False), (True, True)):
            chosen = [
                r
                for r in rows
                if (r["slop"] > 0) == sloppy
                and (not sloppy or (len(terms[r["phrase_id"]]) < r["n_terms"]) == repeats)
            ]
            if not chosen:
                continue
            rare_rows = sum(known[r["field"], r["term"]]["df"] for r in chosen if r["rarest"])
            all_rows = sum(known[r["field"], r["term"]]["df"] for r in chosen)
            few = rare_rows <= BROADCAST_ROWS and all_rows >= ANCHOR_GAIN * rare_rows
            looked_up = local_rows(self.spark, chosen, schema)
            held = postings if few else self._by_document(postings, looked_up, "dl_q", "positions")
            candidates = PH.phrase_candidates(held, looked_up, few)
            if repeats:
                frequencies.append(PH.repeated_frequency(candidates))
            elif sloppy:
                frequencies.append(PH.sloppy_frequency(candidates, max(r["n_terms"] for r in chosen)))
            else:
                frequencies.append(PH.exact_frequency(candidates))
        freq = reduce(DataFrame.unionByName, frequencies)
        facts = local_rows(
            self.spark,
            info,
            "phrase_id int, query_id int, slot string, weight double, idf double, avgdl double",
        )
        score = F.col("weight") * term_score(
            self.model, F.col("idf"), F.col("freq"), F.col("dl_q"), F.col("avgdl")
        )
        return freq.join(F.broadcast(facts), "phrase_id").select(
            "query_id", "slot", "doc_id", score.alias("score")
        )

    def _hits_of_all(self, alls: list) -> DataFrame:
        rows = F.array(
            *[
                F.struct(
                    F.lit(q).alias("query_id"), F.lit(s).alias("slot"), F.lit(float(b)).alias("score")
                )
                for q, s, b in alls
            ]
        )
        return self.store.docs(self.at).select("doc_id", F.inline(rows)).select(
            "query_id", "slot", "doc_id", "score"
        )
