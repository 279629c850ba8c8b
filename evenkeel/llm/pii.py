"""Information-theoretic sanitisation of personal data, in DataFrame operations only.

Protected entities (addresses of mail and net, card and telephone numbers) are
found by patterns. Words that stand in the documents of an entity may reveal it
as well. The corpus says how strongly: with p(x) the share of documents that
hold x, a term t discloses the part

    log(p(e, t) / (p(e) p(t))) / log(1 / p(e)) = 1 - log(p(e | t)) / log(p(e))

of the information of entity e, 1 if t stands only where e does. Terms that
disclose ``GENERALISE`` of an entity or more are replaced by a general word,
from ``REMOVE`` on removed, wherever they stand in the corpus.

Counts are of distinct contents: equal texts count once, and so do near-equal
ones that hold the same entities (of those with equal entities, texts that share
a band of min-hashes of five-word shingles, in two steps). A copied text is no
second witness. For p(e | t) stands what the other contents say of each one that
holds t: with one content left out, the lower end of its interval of one
standard error (Wilson). So a word that meets an entity in one content discloses
nothing by that, and a rare pair less than a frequent one of the same share. As
very many terms are asked, a pair must also be no chance: contents drawn blindly
must bring the entity together as often with any of the terms that can stand in
as many contents (all occurrences of terms, divided by their number) with a
probability of at most ``CHANCE``. ``per_pair`` leaves nothing out and asks that
of each pair alone: then each word of an address's only text may be treated.

Terms are all runs of letters, digits and underscores outside the patterns'
spans; in scripts without blanks between words, all pairs of neighbours. All
counts cover all documents, by partial sums. Entities that stand in the same
contents are one class, terms likewise (told apart by their number of contents
and 128 bits of hash), and pairs are formed of classes, so a list of a million
addresses in one document is one class of entities. Only what cannot change the
result is left out: entities of a single content, terms that meet no entity in two
contents, terms in so many contents that they cannot reach
``GENERALISE`` for any entity beside them (p(e, t) is at most p(e), so a term
discloses no more than log(p(t)) / log(p(e)) if it is the more frequent one), and
terms in so few that not even meeting in all of them is proof.

Defined results: a null text is empty; rows with equal id and text are one
document in the counts and get equal results; a null id is an id of its own; a
span of a term never overlaps a pattern's span; an empty table gives an empty
result; extra columns, whatever their names, are kept by ``sanitise`` and not
read. Work on a text grows in proportion to it and to its spans: a text of many
megabytes with a hundred thousand spans is one row like others.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, discard, unused

KINDS = ("email", "ip", "card", "phone", "term")
#: Rows of one term or key each, some 50 bytes, up to which a table is broadcast.
SENT = 400_000
#: Shares of an entity's information from which a term is treated, and the probability up to which meeting is no chance.
GENERALISE, REMOVE, CHANCE = 0.8, 0.95, 0.01
#: Of so many documents one is counted first, to see which terms are too common to be asked; the rest is counted in all.
PART = 16
#: Bands of two min-hashes by which texts are near-equal: at a similarity of 0.8 all are missed with a probability of 0.0003.
BANDS = 8

# The base patterns, written so that no text makes the engine go back over what it has read:
# a match begins where a run of its first characters begins, or where the last match ended.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}"
# runs of digits with single separators, of the right number of digits; others are matches that would be dropped
_CARD = r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
_PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
# scripts that have no blanks between words
_DENSE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}ー\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_TERM = rf"[{_DENSE}]++|[\p{{L}}\p{{M}}\p{{N}}_&&[^{_DENSE}]]++"
#: The same where no such script is, and where all is ASCII, which are much faster to look for.
_SPACED_TERM, _ASCII_TERM = r"[\p{L}\p{M}\p{N}_]++", r"\w++"


def _by_script(text: Column, of) -> Column:
    """``of`` the pattern of terms that the text needs."""
    dense = text.rlike(f"[{_DENSE}]")
    return F.when(F.octet_length(text) == F.length(text), of(_ASCII_TERM)).when(dense, of(_TERM)).otherwise(of(_SPACED_TERM))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    d = _digits(value)

    def worth(i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda a, i: a + worth(i)) % 10 == 0


def _ip_ok(value: Column) -> Column:
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(part(p)) <= 3, F.concat(F.lit("0"), part(p)).cast("int")).otherwise(256) <= 255)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # without a match of this there is none of the pattern

    def keeps(self, value: Column) -> Column:
        if self.name == "ip":
            return _ip_ok(value)
        if self.name == "card":
            return _luhn(value)
        if self.name == "phone":
            return F.length(_digits(value)).between(9, 15)
        return F.lit(True)

    def entity(self, value: Column) -> Column:
        """The form in which values that are written differently are one entity."""
        return F.lower(value) if self.name == "email" else value if self.name == "ip" else _digits(value)


BASE = (Kind("email", _EMAIL, "@"), Kind("ip", _IP, r"[0-9]\.[0-9]"), Kind("card", _CARD, "[0-9][ -]?[0-9]"), Kind("phone", _PHONE, r"\+[0-9]"))


#: Elements of an array that one partial sum spans.
_BLOCK = 256


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def located(df: DataFrame, searches: dict[str, tuple[Column, str, Column | None]]) -> DataFrame:
    """Add, for each search (text, pattern, condition), ``__v_`` the matches and ``__t_`` the characters before each.

    Every step is a column of its own, so that no step is computed again for
    each element of the next; the sums before each element go by blocks, so
    long arrays stay cheap.
    """
    col = lambda x, name: F.col(f"__{x}_{name}")
    strings, numbers = F.array().cast("array<string>"), F.array().cast("array<int>")
    found, gaps, steps, starts, before = {}, {}, {}, {}, {}
    for name, (text, pattern, there) in searches.items():
        v, g, s, b = (col(x, name) for x in "vgsb")
        match = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        found[f"__v_{name}"] = F.coalesce(match if there is None else F.when(there, match), strings)
        gaps[f"__g_{name}"] = F.when(F.size(v) > 0, F.transform(F.split(text, pattern, -1), F.length)).otherwise(numbers)
        steps[f"__s_{name}"] = F.transform(v, _step(g))
        starts[f"__b_{name}"] = _block_starts(s)
        before[f"__t_{name}"] = F.transform(s, _before(s, b, g))
    for stage in (found, gaps, steps, starts, before):
        df = df.withColumns(stage)
    return df.drop(*[f"__{x}_{name}" for x in "gsb" for name in searches])


def _step(gaps: Column):
    """How far a match and the text before it go."""
    return lambda m, i: F.get(gaps, i) + F.length(m)


def _block_starts(steps: Column) -> Column:
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / _BLOCK).cast("int")), lambda b: _total(F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK))))
    return F.aggregate(blocks, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))


def _sum_before(steps: Column, starts: Column, i: Column) -> Column:
    # each column is named twice: one that is named once would be computed again for each element
    block = F.floor(i / _BLOCK).cast("int")
    return F.when(F.size(starts) > block, F.get(starts, block)) + _total(F.slice(steps, block * _BLOCK + 1, i % _BLOCK))


def _before(steps: Column, starts: Column, gaps: Column):
    return lambda _, i: _sum_before(steps, starts, i) + F.get(gaps, i)


def _kept(i: int, kind: Kind, values: Column, before: Column) -> Column:
    """The spans of a kind's matches that hold."""

    def span(m: Column, k: Column) -> Column:
        s = F.get(before, k)
        entity = F.concat(F.lit(f"{kind.name}:"), kind.entity(m))
        return F.struct(s.alias("s"), F.lit(i).alias("kind"), (s + F.length(m)).alias("e"), entity.alias("entity"), kind.keeps(m).alias("ok"))

    def without_ok(x: Column) -> Column:
        return F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"), x["entity"].alias("entity"))

    return F.transform(F.filter(F.transform(values, span), lambda x: x["ok"]), without_ok)


def base_spans(docs: DataFrame, text: str) -> DataFrame:
    """Add ``spans``: the patterns' spans (s, kind, e, entity) by start, then kind; code points, end exclusive."""
    searches = {kind.name: (F.col(text), kind.pattern, F.col(text).rlike(kind.needs)) for kind in BASE}
    docs = located(docs, searches)
    parts = [_kept(i, kind, F.col(f"__v_{kind.name}"), F.col(f"__t_{kind.name}")) for i, kind in enumerate(BASE)]
    docs = docs.withColumn("spans", F.sort_array(F.concat(*parts)))
    return docs.drop(*[f"__{x}_{kind.name}" for x in "vt" for kind in BASE])


#: Characters in a block of a text that is taken apart.
_PART = 1024


def _blocks(text: Column) -> Column:
    """The text in blocks: a part is found without reading what is before it. Kept as a column, or it is made anew for each part."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PART}}}"), F.lit(0))


def _part(blocks: Column, a: Column, b: Column) -> Column:
    """The characters from ``a`` to before ``b``."""
    first, last = F.floor(a / _PART).cast("int"), F.floor((b - 1) / _PART).cast("int")
    inner = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    many = F.concat(F.substring(F.get(blocks, first), a % _PART + 1, F.lit(_PART)), inner, F.substring(F.get(blocks, last), F.lit(1), (b - 1) % _PART + 1))
    return F.when(b <= a, "").when(first == last, F.substring(F.get(blocks, first), a % _PART + 1, b - a)).otherwise(many)


def _rest(blocks: Column, a: Column) -> Column:
    """The characters from ``a`` on."""
    first = F.floor(a / _PART).cast("int")
    return F.concat(F.coalesce(F.substring(F.get(blocks, first), a % _PART + 1, F.lit(_PART)), F.lit("")), F.array_join(F.slice(blocks, first + 2, F.size(blocks)), ""))


def united(df: DataFrame, spans: Column, out: str) -> DataFrame:
    """Add ``out``: the spans (s, kind, e) in order, those that overlap as one under the kind of the first.

    Starts and ends are sorted together; a span begins where none was open.
    """
    x = {n: f"__{out}_{n}" for n in ("events", "steps", "sums", "starts", "ends")}
    edge = lambda at, step: F.transform(spans, lambda y: F.struct(y[at].alias("p"), F.lit(step).alias("step"), y["kind"].alias("kind")))
    df = df.withColumn(x["events"], F.sort_array(F.concat(edge("s", 1), edge("e", -1))))
    df = df.withColumn(x["steps"], F.transform(x["events"], lambda y: y["step"]))
    df = df.withColumn(x["sums"], _block_starts(F.col(x["steps"])))
    at = lambda step, open_: F.filter(x["events"], lambda y, i: (y["step"] == step) & (_sum_before(F.col(x["steps"]), F.col(x["sums"]), i) == open_))
    df = df.withColumns({x["starts"]: at(1, 0), x["ends"]: at(-1, 1)})
    whole = F.zip_with(x["starts"], x["ends"], lambda a, b: F.struct(a["p"].alias("s"), a["kind"].alias("kind"), b["p"].alias("e")))
    return df.withColumn(out, whole).drop(*x.values())


def _blanked(blocks: Column, covered: Column) -> Column:
    """The text with blanks in place of the spans; all else keeps its place."""
    upto = lambda i: F.when(i > 0, F.get(covered, i - 1)["e"]).otherwise(0)
    parts = F.transform(covered, lambda x, i: F.concat(_part(blocks, upto(i), x["s"]), F.repeat(F.lit(" "), x["e"] - x["s"])))
    return F.concat(F.array_join(parts, ""), _rest(blocks, F.get(covered, F.size(covered) - 1)["e"]))


def _pairs(run: Column) -> Column:
    """The pairs of neighbours in a run of a script without blanks, with their places."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.length(run) - 2, F.lit(0))), lambda i: F.struct(F.substring(run, i + 1, F.lit(2)).alias("m"), i.alias("at")))


def _folded(text: Column) -> Column:
    """Lower case that does not depend on what stands beside a term."""
    return F.replace(F.lower(text), F.lit("ς"), F.lit("σ"))


def _terms(text: Column) -> Column:
    """The different terms of a text."""
    found = _by_script(text, lambda pattern: F.regexp_extract_all(_folded(text), F.lit(pattern), F.lit(0)))
    dense = lambda m: F.when(m.rlike(f"^[{_DENSE}]"), F.transform(_pairs(m), lambda x: x["m"])).otherwise(F.array(m))
    any_dense = (F.octet_length(text) > F.length(text)) & text.rlike(f"[{_DENSE}]")
    return F.array_distinct(F.when(any_dense, F.flatten(F.transform(found, dense))).otherwise(found))


def _term_places(texts: DataFrame, told: DataFrame) -> DataFrame:
    """``(key, s, e, disclosed)`` of the terms of the texts (key, clear) that are told (term, disclosed)."""
    found = cut(texts.select("key", _by_script(F.col("clear"), lambda pattern: F.regexp_extract_all("clear", F.lit(pattern), F.lit(0))).alias("v"),
        F.transform(_by_script(F.col("clear"), lambda pattern: F.split("clear", pattern, -1)), F.length).alias("g")), "found_terms")
    one = found.select("key", F.posexplode("v").alias("i", "m"))
    whole = F.array(F.struct(F.col("m").alias("m"), F.lit(0).alias("at")))
    one = one.select("key", "i", F.explode(F.when((F.octet_length("m") > F.length("m")) & F.col("m").rlike(f"^[{_DENSE}]"), _pairs(F.col("m"))).otherwise(whole)).alias("x"))
    one = one.select("key", "i", "x.at", F.length("x.m").alias("n"), _folded(F.col("x.m")).alias("term")).join(told, "term")
    hits = one.groupBy("key").agg(F.collect_list(F.struct("i", "at", "n", "disclosed")).alias("hits"))
    steps = found.select("key", "g", F.transform("v", _step(F.col("g"))).alias("steps")).join(hits, "key").withColumn("starts", _block_starts(F.col("steps")))
    before = _before(F.col("steps"), F.col("starts"), F.col("g"))

    def place(x: Column) -> Column:
        s = before(x, x["i"]) + x["at"]
        return F.struct(s.alias("s"), (s + x["n"]).alias("e"), x["disclosed"].alias("disclosed"))

    return steps.select("key", F.explode(F.transform("hits", place)).alias("x")).select("key", "x.*")


def _documents(of: str) -> list[Column]:
    """Of the rows of a group: their number, and two hashes of the set of their keys."""
    return [F.count("*").alias(f"n_{of}"), *[F.bit_xor(F.xxhash64("key", F.lit(i))).alias(f"{of}_{i}") for i in (1, 2)]]


def _key(id_col: str, text_col: str) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col))))


def _evidence(both: Column, one: Column, other: Column, n: Column) -> Column:
    """-log of a bound on the probability that ``one`` documents of ``n``, drawn blindly, hold ``both`` or more of ``other`` (Hoeffding)."""
    a, p = both / one, other / n
    rest = F.when(a < 1, (1 - a) * F.log(F.try_divide(1 - a, 1 - p))).otherwise(0.0)
    return F.when(a > p, one * (a * F.log(a / p) + rest)).otherwise(0.0)


def _lower(k: Column, n: Column) -> Column:
    """The lower end of the interval of one standard error of a share of ``k`` in ``n`` (Wilson); null for none."""
    p = F.try_divide(k, n)
    return F.when(k > 0, (p + 0.5 / n - F.sqrt(p * (1 - p) / n + 0.25 / (n * n))) / (1 + 1.0 / n))


def _disclosed(both: Column, entity: Column, term: Column, n: Column, proof: Column, left_out: int) -> Column:
    """The share of an entity's information that a term discloses; null if their meeting is no proof."""
    sure = F.greatest(_evidence(both, entity, term, n), _evidence(both, term, entity, n)) >= proof
    return F.when((n > entity) & sure, 1 - F.log(_lower(both - left_out, term - left_out)) / F.log(entity / n))


def _most_evidence(documents: Column, n_docs: int) -> Column:
    """What meeting in ``documents`` documents or fewer can prove at most: k log(n / k), which grows up to n / e."""
    k = F.least(documents.cast("double"), F.lit(n_docs / math.e))
    return k * F.log(n_docs / k)


def _cleared(texts: DataFrame) -> DataFrame:
    """Add to ``text`` its ``spans`` and ``clear``, the text with blanks in their place."""
    found = united(base_spans(texts, "text"), F.col("spans"), "covered")
    found = found.withColumn("blocks", F.when(F.size("spans") > 0, _blocks(F.col("text"))))
    return found.withColumn("clear", F.when(F.size("spans") > 0, _blanked(F.col("blocks"), F.col("covered"))).otherwise(F.col("text")))


def _sent(few: DataFrame) -> DataFrame:
    """A stored table that is broadcast if it has ``SENT`` rows at most; else its join is left to Spark, which shuffles."""
    return F.broadcast(few) if few.count() <= SENT else few


def _shingles(words: Column) -> Column:
    """Hashes of the five-word shingles of a stored array of words; of all words, if there are fewer."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.size(words) - 5, F.lit(0))), lambda i: F.xxhash64(F.slice(words, i + 1, F.lit(5))))


def _same_contents(texts: DataFrame, found: DataFrame) -> DataFrame:
    """``key`` of the documents that are no contents of their own: copies, and near copies with the same entities."""
    plain = found.where("size(spans) = 0").select("key", "content").distinct()
    copies = plain.join(plain.groupBy("content").agg(F.min("key").alias("first"), F.count("*").alias("k")).where("k > 1"), "content").where("key <> first").select("key")
    holders = found.where("size(spans) > 0").select("key", F.md5(F.array_join(F.array_sort(F.array_distinct("spans.entity")), "\n")).alias("held")).distinct()
    several = holders.groupBy("held").agg(F.count("*").alias("k")).where("k > 1")
    holders = cut(holders.join(several, "held").select("key", "held"), "holders")
    keys = _sent(holders)
    # words and shingles are stored, or they would be made anew for each element of what is made of them
    split = cut(texts.select("key", "text").join(keys, "key").select("key", "held", F.split(F.lower("text"), "[\\x20\\x09-\\x0D]+").alias("w")), "holders-words")
    shingled = cut(split.select("key", "held", _shingles(F.col("w")).alias("h")).dropDuplicates(["key"]), "shingled")
    least = lambda seed: F.array_min(F.transform("h", lambda x: F.xxhash64(x, F.lit(seed))))
    lows = shingled.select("key", "held", *[least(i).alias(f"m{i}") for i in range(2 * BANDS)])
    bands = F.array(*[F.xxhash64("held", F.lit(i), f"m{2 * i}", f"m{2 * i + 1}") for i in range(BANDS)])
    bands = cut(lows.select("key", F.explode(bands).alias("band")), "near-bands")
    label = bands.select("key", F.col("key").alias("first"), "band")
    for _ in range(2):
        first = label.groupBy("band").agg(F.min("first").alias("first"))
        first = bands.join(first, "band").groupBy("key").agg(F.min("first").alias("first"))
        label = bands.join(first, "key")
    near = first.where("key <> first").select("key")
    out = cut(copies.union(near), "same-contents")
    discard(holders, split, shingled, bands)
    return out


def find(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_pair: bool = False) -> DataFrame:
    """``doc_id, key, spans, terms`` of each row: the patterns' spans, and those of disclosing terms (s, kind, e, disclosed)."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("key", _key("doc_id", "text"))
    left_out = 0 if per_pair else 1
    # spans are found anew where texts are read: that is less work than to store the texts
    found = cut(base_spans(texts, "text").select("doc_id", "key", "spans", F.unhex(F.md5("text")).alias("content")), "found")
    # rows with equal id and text are one document; nothing moves if there are none
    repeated = not found.groupBy("key").count().where("count > 1").isEmpty()
    once = lambda df: df.dropDuplicates(["key"]) if repeated else df
    none = F.array().cast("array<struct<s:int,kind:int,e:int,disclosed:double>>")
    nothing = found.select("doc_id", "key", "spans").withColumn("terms", none)
    same = _same_contents(texts, found)
    away = _sent(same)
    own = found.where("size(spans) > 0").join(away, "key", "left_anti").select("key", F.explode(F.array_distinct("spans.entity")).alias("entity")).distinct()
    own = cut(own, "entities")
    entities = cut(own.groupBy("entity").agg(*_documents("entity")).where(F.col("n_entity") > left_out), "counted_entities")
    most = entities.agg(F.max("n_entity")).first()[0]
    if most is None:
        return nothing
    words = cut(once(_cleared(texts).select("key", F.size("spans").alias("n"), _terms(F.col("clear")).alias("words"))), "words")
    counted_docs = words.join(away, "key", "left_anti")
    n_docs, occurrences = counted_docs.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    entity_class, term_class = ["n_entity", "entity_1", "entity_2"], ["n_term", "term_1", "term_2"]
    beside = cut(own.join(entities, "entity").select("key", *entity_class).distinct(), "beside")
    near = counted_docs.where("n > 0").join(_sent(cut(beside.select("key").distinct(), "holders")), "key", "left_semi")
    near = cut(near.select("key", F.explode("words").alias("term")), "near")
    # what a term discloses of an entity in fewer documents is log(p(t)) / log(p(e)) at most
    reach = lambda n_entity: F.pow(F.lit(float(n_docs)), 1 - GENERALISE) * F.pow(n_entity, GENERALISE) * (1 + 1e-9)
    # how often a term stands at least: beside these entities, and in a part of all documents; that bounds what it can disclose
    part = counted_docs.where(F.pmod(F.xxhash64("key"), F.lit(PART)) == 0).select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("part"))
    few = near.groupBy("term").agg(F.count("*").alias("k")).where((F.col("k") > left_out) & (F.col("k") <= reach(F.lit(most))))
    few = few.join(part, "term", "left").select("term", F.greatest("k", "part").alias("least"))
    near = cut(near.join(few, "term"), "near-few")
    met = near.join(beside, "key").groupBy("term", "least", *entity_class).agg(F.count("*").alias("k"))
    share = F.pow(F.col("n_entity") / F.lit(float(n_docs)), F.lit(1 - GENERALISE))  # of a term's contents that must hold the entity
    met = met.where((F.col("k") > left_out) & (F.col("k") * (1 + 1e-9) >= F.col("least") * share))
    asked = _sent(cut(met.select("term").distinct(), "asked"))
    # all terms are counted, whatever is asked: the same work for any data of one size
    every = cut(counted_docs.select("key", F.explode("words").alias("term")).groupBy("term").agg(*_documents("term")), "all-terms")
    counted = every.join(asked, "term")
    proof = F.lit(-math.log(CHANCE)) if per_pair else F.log(F.lit(float(occurrences)) / F.col("n_term") / CHANCE)
    proof = proof - 1e-9
    counted = cut(counted.where((F.col("n_term") <= reach(F.lit(most))) & (_most_evidence(F.col("n_term"), n_docs) >= proof)), "counted_terms")
    discard(every)
    can = (F.col("n_term") <= reach(F.col("n_entity"))) & (_most_evidence(F.least("n_term", "n_entity"), n_docs) >= proof)
    near = near.join(counted, "term").select("key", *term_class).distinct()
    pairs = near.join(beside, (near["key"] == beside["key"]) & can).drop("key")
    pairs = pairs.groupBy(*term_class, *entity_class).agg(F.count("*").alias("n_both"))
    told = pairs.withColumn("disclosed", _disclosed(F.col("n_both"), F.col("n_entity"), F.col("n_term"), F.lit(n_docs), proof, left_out))
    told = told.where(F.col("disclosed") >= GENERALISE).groupBy(*term_class).agg(F.max("disclosed").alias("disclosed"))
    told = cut(counted.join(told, term_class).select("term", "disclosed"), "told")
    if told.isEmpty():
        discard(words, own, entities, beside, same, told)
        return nothing
    sent = _sent(told)
    keys = _sent(cut(words.select("key", F.explode("words").alias("term")).join(sent, "term").select("key").distinct(), "marked"))
    discard(words, own, entities, beside, same)
    marked = once(_cleared(texts.select("key", "text").join(keys, "key", "left_semi")).select("key", "clear"))
    terms = cut(_term_places(marked, sent), "places")
    terms = terms.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("s", F.lit(len(BASE)).alias("kind"), "e", "disclosed"))).alias("terms"))
    out = found.select("doc_id", "key", "spans").join(terms, "key", "left")
    return out.withColumn("terms", F.coalesce("terms", none))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"], x["e"])), ",")


def plain(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))


def sanitise(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", per_pair: bool = False) -> DataFrame:
    """``docs`` with all spans replaced in the text: entities and terms by their kind, the strongest terms by nothing."""
    found = find(docs, id_col=id_col, text_col=text_col, per_pair=per_pair).where("size(spans) > 0 or size(terms) > 0").dropDuplicates(["key"])
    removed = F.transform(
        F.col("terms"), lambda x: F.struct(x["s"].alias("s"), F.when(x["disclosed"] >= REMOVE, len(KINDS)).otherwise(x["kind"]).alias("kind"), x["e"].alias("e"))
    )
    found = united(found.withColumn("every", F.concat(plain(F.col("spans")), removed)), F.col("every"), "merged")
    key, merged, blocks = unused(docs, "key", "merged", "blocks")
    found = found.select(F.col("key").alias(key), F.col("merged").alias(merged))
    out = docs.withColumn(key, _key(id_col, text_col)).join(found, key, "left")
    out = out.withColumn(blocks, F.when(F.col(merged).isNotNull(), _blocks(F.col(text_col))))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS], F.lit(""))
    blocks, merged = F.col(blocks), F.col(merged)
    upto = lambda i: F.when(i > 0, F.get(merged, i - 1)["e"]).otherwise(0)
    parts = F.transform(merged, lambda x, i: F.concat(_part(blocks, upto(i), x["s"]), F.element_at(tags, x["kind"] + 1)))
    tail = _rest(blocks, F.get(merged, F.size(merged) - 1)["e"])
    clean = F.when(merged.isNotNull(), F.concat(F.array_join(parts, ""), tail)).otherwise(F.col(text_col))
    return out.withColumn(text_col, clean).select(*docs.columns)
