"""Personal data, in DataFrame functions alone: base patterns, and terms that reveal a protected value.

Base kinds are regular expressions with checks. The method then protects every base value (an entity): over the whole corpus it
counts in how many documents a term stands near the entity, how many hold the entity, and how many the term. Point-wise mutual
information log2(N n_et / (n_e df_t)) says how much the term discloses of the entity's information content log2(N / n_e). A term
that discloses at least ``DISCLOSURE`` of it, seen in ``SUPPORT`` different contexts, is marked wherever it stands in a document
with that entity. Documents are different contexts whatever stands beside the value, unless they are near copies of each other:
copied documents disclose nothing new. Inside a document, occurrences with other words right beside them are contexts too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from walrill.llm.common import materialise
from walrill.llm.graph import components

KINDS = ("email", "ip", "card", "phone", "term")
#: The contract's patterns, written so that no text takes more than linear time: a match never needs to start inside a run
#: that it could take from its beginning, and repetitions that nothing can shorten are possessive.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Cheap conditions without which a pattern can't match.
GUARDS = {"email": lambda t: t.contains("@"), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"), "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9]"), "phone": lambda t: t.contains("+")}
#: Share of an entity's information that a term may not disclose, and the least number of different contexts.
DISCLOSURE, SUPPORT = 0.9, 3
#: Characters on either side of an entity that are its context.
CONTEXT = 300
#: Shorter words are terms where they are written like a name, with a capital or in a script that has none.
TERM = r"(?<!\S)(?:\p{L}{4,}|[\p{Lu}\p{Lt}\p{Lo}]\p{L}{0,2})(?=[.,;:!?]*(?:\s|$))"
#: Texts whose five-word shingles have this similarity are copies; one is missed with a probability of (1 - 0.8**3)**16 = 1e-5.
COPY_PERCENT, COPY_BANDS, COPY_ROWS = 80, 16, 3


def _raw_hits(text: Column, kind: str) -> Column:
    """(kind, value, characters since the last match of the kind) of each match in order."""
    pattern = F.lit(PATTERNS[kind])
    pairs = F.arrays_zip(F.regexp_extract_all(text, pattern, F.lit(0)).alias("v"), F.split(text, PATTERNS[kind], -1).alias("p"))
    hits = F.transform(F.filter(pairs, lambda x: x["v"].isNotNull()), lambda x: F.struct(F.lit(KINDS.index(kind)).alias("kind"), x["v"].alias("value"), F.length(x["p"]).alias("gap")))
    return F.when(GUARDS[kind](text), hits).otherwise(F.array().cast("array<struct<kind:int,value:string,gap:int>>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum of digits, every second from the right doubled and its own digits added, is a multiple of ten."""
    value = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
    part = lambda i: F.when(i % 2 == 1, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), part), F.lit(0), lambda a, b: a + b) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    digits = _digits(value)
    small = F.forall(F.split(value, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(F.split(value, r"\."), lambda p: F.right(p, F.lit(4)).cast("int") <= 255)
    card = F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    return F.when(kind == 0, True).when(kind == 1, small).when(kind == 2, card).otherwise(F.length(digits).between(9, 15))


def _placed(rows: DataFrame) -> DataFrame:
    """(uid, kind, value, start, end) of all raw hits: places are running sums of gaps and lengths of one text's matches."""
    hits = rows.select("uid", F.posexplode("hits").alias("pos", "hit")).select("uid", "pos", "hit.*")
    upto = Window.partitionBy("uid", "kind").orderBy("pos")
    length = F.length("value")
    return hits.select("uid", "kind", "value", (F.sum(F.col("gap") + length).over(upto)).alias("end"), length.alias("n")).select("uid", "kind", "value", (F.col("end") - F.col("n")).alias("start"), "end")


def _contexts(found: DataFrame, texts: DataFrame) -> DataFrame:
    """(uid, entity, context, terms) for each base hit: the words next to it, without those that a cut has shortened."""
    joined = found.where(F.col("kind") < 4).join(texts, "uid")
    left = F.substring(F.col("text"), F.greatest(F.lit(1), F.col("start") - CONTEXT + 1), F.least(F.lit(CONTEXT), F.col("start")))
    right = F.substring(F.col("text"), F.col("end") + 1, F.lit(CONTEXT))
    left = F.when(F.col("start") > CONTEXT, F.regexp_replace(left, r"^\S+", "")).otherwise(left)
    right = F.when(F.length(right) == CONTEXT, F.regexp_replace(right, r"\S+$", "")).otherwise(right)
    words = F.transform(F.concat(F.regexp_extract_all(left, F.lit(TERM), F.lit(0)), F.regexp_extract_all(right, F.lit(TERM), F.lit(0))), F.lower)
    entity = F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1), F.when(F.col("kind") == 0, F.lower("value")).when(F.col("kind") == 1, F.col("value")).otherwise(_digits(F.col("value"))))
    # Two occurrences in one document stand in one context if the words right beside them are the same.
    beside = F.xxhash64(F.regexp_extract(F.lower(left), r"(\S+)\s*$", 1), F.regexp_extract(F.lower(right), r"^\s*(\S+)", 1))
    return joined.select("uid", entity.alias("entity"), beside.alias("context"), F.array_distinct(words).alias("terms"))


def _copies(texts: DataFrame) -> DataFrame:
    """(uid, copy) of each row of ``texts`` (uid, text): rows have the same copy if their texts are equal or near copies."""
    keyed = materialise(texts.select("uid", F.xxhash64("text").alias("node"), "text"))
    # Written between the steps, so that no step is computed again for each element of the next.
    words = materialise(keyed.dropDuplicates(["node"]).select("node", F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "").alias("w")))
    places = F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1)))
    sets = materialise(words.select("node", F.array_distinct(F.transform(places, lambda i: F.xxhash64(F.slice("w", i, F.lit(5))))).alias("s")))
    least = lambda i: F.array_min(F.transform("s", lambda x: F.xxhash64(x, F.lit(i))))
    bands = F.array(*(F.xxhash64(F.lit(b), *(least(b * COPY_ROWS + r) for r in range(COPY_ROWS))) for b in range(COPY_BANDS)))
    members = materialise(sets.select("node", F.explode(bands).alias("bucket")))
    heads = members.groupBy("bucket").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket", "head")
    pairs = members.join(heads, "bucket").where("node <> head").select("node", "head").distinct()
    both = pairs.join(sets, "node").join(sets.select(F.col("node").alias("head"), F.col("s").alias("t")), "head")
    meet = F.size(F.array_intersect("s", "t"))
    links = both.where(100 * meet >= COPY_PERCENT * (F.size("s") + F.size("t") - meet)).select(F.col("node").alias("a"), F.col("head").alias("b"))
    groups = components(materialise(links))
    return keyed.join(groups, "node", "left").select("uid", F.coalesce("component", "node").alias("copy"))


def revealing_terms(contexts: DataFrame, docs: DataFrame, texts: DataFrame, text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """(entity, term) of all terms that disclose at least the given share of an entity's information.

    All counts are over the whole corpus and pre-aggregated before each exchange; a frequent entity or term is a key with
    many rows only until its task-side counts are made."""
    n_e = contexts.select("entity", "uid", "context").distinct().groupBy("entity", "uid").agg(F.count(F.lit(1)).alias("here"))
    n_e = materialise(n_e.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), F.sum("here").alias("all")).where(F.col("all") >= support).drop("all"))
    often = materialise(contexts.join(n_e.select("entity"), "entity", "left_semi"))
    copies = materialise(_copies(texts.join(often.select("uid").distinct(), "uid", "left_semi")))
    # A term's contexts in each document, then the most of any copy, so that copies count once; documents count all.
    near = often.select("entity", "uid", "context", F.explode("terms").alias("term")).distinct().groupBy("entity", "term", "uid").agg(F.count(F.lit(1)).alias("here"))
    near = near.join(copies, "uid").groupBy("entity", "term", "copy").agg(F.max("here").alias("here"), F.count(F.lit(1)).alias("documents"))
    n_et = near.groupBy("entity", "term").agg(F.sum("here").alias("different"), F.sum("documents").alias("n_et")).where(F.col("different") >= support).drop("different")
    near = materialise(n_et.join(n_e, "entity"))
    # Every word's document count, a row for each word after task-side counts; only then do the few near terms meet it.
    words = docs.select(F.explode(F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: w != "")).alias("term"))
    df_t = words.groupBy("term").agg(F.count(F.lit(1)).alias("df_t"))
    n = docs.count()
    bits = lambda x: F.log2(x.cast("double"))
    told = bits(F.lit(n) * F.col("n_et")) - bits(F.col("n_e") * F.col("df_t"))
    whole = bits(F.lit(n)) - bits(F.col("n_e"))
    return near.join(df_t, "term").where(whole > 0).where(told >= disclosure * whole).select("entity", "term")


def _term_spans(contexts: DataFrame, revealing: DataFrame, texts: DataFrame) -> DataFrame:
    """(uid, kind 4, value, start, end) of each occurrence of a revealing term in a document with its entity."""
    wanted = contexts.select("uid", "entity").distinct().join(revealing, "entity").select("uid", "term").distinct().join(texts, "uid")
    pattern = F.concat(F.lit(r"(?iu)(?<!\S)\Q"), F.col("term"), F.lit(r"\E(?=[.,;:!?]*(?:\s|$))"))
    pieces = wanted.select("uid", "term", F.split(F.col("text"), pattern, F.lit(-1)).alias("p"))
    hits = pieces.select("uid", "term", F.posexplode(F.slice("p", 1, F.size("p") - 1)).alias("pos", "gap"))
    upto = Window.partitionBy("uid", "term").orderBy("pos")
    end = F.sum(F.length("gap") + F.length("term")).over(upto)
    return hits.select("uid", F.lit(4).alias("kind"), F.col("term").alias("value"), (end - F.length("term")).alias("start"), end.alias("end"))


def _listed(spans: Column, base: bool) -> Column:
    chosen = F.filter(spans, lambda s: s["kind"] < 4) if base else spans
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(chosen), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_term of each row of ``docs`` (doc_id, text).

    Null and empty texts have no spans. Rows with null or repeated ids are rows of their own. Places count code points, ends
    are exclusive; spans of different kinds may overlap, and terms inside a base span are not marked again."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("uid"))
    hits = F.concat(*(_raw_hits(F.col("text"), k) for k in KINDS[:4]))
    # One pass over all texts; only texts with a hit are kept beside their row.
    found = narrow.select("doc_id", "uid", F.coalesce(hits, F.array().cast("array<struct<kind:int,value:string,gap:int>>")).alias("hits"), "text")
    rows = materialise(found.select("doc_id", "uid", "hits", F.when(F.size("hits") > 0, F.col("text")).alias("text")))
    texts = rows.where(F.size("hits") > 0).select("uid", "text")
    base = materialise(_placed(rows).where(_valid(F.col("kind"), F.col("value"))))
    contexts = materialise(_contexts(base, texts))
    terms = _term_spans(contexts, revealing_terms(contexts, docs, texts), texts)
    covered = base.select(F.col("uid").alias("b_uid"), F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    terms = terms.join(covered, (F.col("uid") == F.col("b_uid")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end")), "left_anti")
    spans = base.select("uid", "kind", "start", "end").unionByName(terms.select("uid", "kind", "start", "end"))
    of_row = spans.groupBy("uid").agg(F.collect_set(F.struct(F.col("start"), F.col("kind"), F.col("end"))).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    out = rows.select("doc_id", "uid").join(of_row, "uid", "left").withColumn("spans", F.coalesce("spans", none))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    return out.select("doc_id", *(number(k) for k in KINDS[:4]), F.sha2(_listed(F.col("spans"), True).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans"), False).alias("spans"), number("term"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and clean_text of each row: every span replaced by its kind in angle brackets, terms generalised likewise.

    Overlapping spans become one, named by the first; null texts stay null."""
    uid = F.monotonically_increasing_id()
    rows = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", uid.alias("uid")))
    spans = find_personal_data(rows.select(F.col("uid").alias("doc_id"), "text")).select(F.col("doc_id").alias("s_uid"), "spans")
    joined = rows.join(spans, F.col("uid") == F.col("s_uid"))
    parsed = F.transform(F.filter(F.split("spans", ","), lambda s: s != ""), lambda s: F.struct(F.split(s, ":")[1].cast("long").alias("a"), F.split(s, ":")[2].cast("long").alias("z"), F.split(s, ":")[0].alias("k")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def add(state: Column, s: Column) -> Column:
        piece = F.substring(F.col("text"), (state["at"] + 1).cast("int"), (s["a"] - state["at"]).cast("int"))
        grown = F.struct(F.concat(state["out"], piece, F.lit("<"), s["k"], F.lit(">")).alias("out"), s["z"].alias("at"))
        wider = F.struct(state["out"].alias("out"), F.greatest(state["at"], s["z"]).alias("at"))
        return F.when(s["a"] >= state["at"], grown).otherwise(wider)

    folded = joined.select("doc_id", "text", F.aggregate(parsed, start, add).alias("f"))
    return folded.select("doc_id", F.concat(F.col("f.out"), F.substring(F.col("text"), (F.col("f.at") + 1).cast("int"), F.length("text"))).alias("clean_text"))
