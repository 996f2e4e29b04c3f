"""Line items and notes from the pages of a filing.

All but ``first_rules`` and ``rarest_pairs`` is a column expression on rows (one
for each document, section or line), so any number of filings goes through one plan.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.amounts import amount_near, cell_amount, context, table_amount
from ..functions.scalars import has_any
from ..sources.scratch import discard, materialize

# Headings that open a section, in order of preference.
SECTION_MARKERS = {
    "pnl": ["RESULTATREGNSKAP", "Driftsinntekter og driftskostnader"],
    "assets": ["BALANSE - EIENDELER", "BALANSE\nEIENDELER", "Eendeler", "Eiendeler | Note"],
    "equity_debt": ["BALANSE - EGENKAPITAL OG GJELD", "EGENKAPITAL OG GJELD", "Egenkapital og gjeld | Note"],
    "notes": ["NOTEOPPLYSNINGER", "Noter til", "Note 0", "Note 1"],
}

# Label contained in a row's text -> key; the first that fits counts.
LINE_ITEM_MAP = {
    "salgsinntekt": "salgsinntekt",
    "salær- og provisjonsinntekt": "salgsinntekt",
    "salær og provisjonsinntekt": "salgsinntekt",
    "annen driftsinntekt": "annen_driftsinntekt",
    "sum inntekter": "sum_driftsinntekter",
    "sum driftsinntekter": "sum_driftsinntekter",
    "varekostnad": "varekostnad",
    "lønnskostnad": "lonnskostnad",
    "avskrivning": "avskrivning",
    "nedskrivning": "nedskrivning",
    "annen driftskostnad": "annen_driftskostnad",
    "sum kostnader": "sum_driftskostnader",
    "sum driftskostnader": "sum_driftskostnader",
    "driftsresultat": "driftsresultat",
    "renteinntekt fra foretak i samme konsern": "renteinntekt_konsern",
    "annen renteinntekt": "annen_renteinntekt",
    "annen finansinntekt": "annen_finansinntekt",
    "sum finansinntekter": "sum_finansinntekter",
    "rentekostnad til foretak i samme konsern": "rentekostnad_konsern",
    "annen rentekostnad": "annen_rentekostnad",
    "annen finanskostnad": "annen_finanskostnad",
    "sum finanskostnader": "sum_finanskostnader",
    "netto finans": "netto_finans",
    "resultat før skattekostnad": "resultat_for_skatt",
    "ordinært resultat før skattekostnad": "resultat_for_skatt",
    "skattekostnad": "skattekostnad",
    "skattekostnad på resultat": "skattekostnad",
    "skattekostnad på ordinært resultat": "skattekostnad",
    "årsresultat": "aarsresultat",
    "ordinært resultat etter skattekostnad": "ord_resultat_etter_skatt",
    "totalresultat": "totalresultat",
    "ordinært utbytte": "utbytte",
    "konsernbidrag": "konsernbidrag",
    "sum eiendeler": "sum_eiendeler",
    "sum anleggsmidler": "sum_anleggsmidler",
    "sum omløpsmidler": "sum_omlopsmidler",
    "kundefordringer": "kundefordringer",
    "andre fordringer": "andre_fordringer",
    "sum fordringer": "sum_fordringer",
    "bankinnskudd, kontanter og lignende": "bankinnskudd",
    "sum bankinnskudd, kontanter og lignende": "bankinnskudd",
    "sum egenkapital": "sum_egenkapital",
    "aksjekapital": "aksjekapital",
    "overkurs": "overkurs",
    "sum innskutt egenkapital": "sum_innskutt_egenkapital",
    "annen egenkapital": "annen_egenkapital",
    "sum opptjent egenkapital": "sum_opptjent_egenkapital",
    "sum langsiktig gjeld": "sum_langsiktig_gjeld",
    "leverandørgjeld": "leverandorgjeld",
    "skyldige offentlige avgifter": "skyldige_offentlige_avgifter",
    "annen kortsiktig gjeld": "annen_kortsiktig_gjeld",
    "sum kortsiktig gjeld": "sum_kortsiktig_gjeld",
    "sum gjeld": "sum_gjeld",
    "sum egenkapital og gjeld": "sum_egenkapital_gjeld",
    "pantstillelse": "pantstillelse",
    "kassekreditt": "kassekreditt",
    "kassekredittlimit": "kassekredittlimit",
    "innbetalt felleskostnader": "felleskostnader",
    "felleskostnader": "felleskostnader",
    "forretningsførerhonorar": "forretningsforerhonorar",
    "revisjonshonorar": "revisjonshonorar",
    "styrehonorar": "styrehonorar",
}

# Keys whose amounts are costs and have no sign.
COST_KEYS = ["lonnskostnad", "varekostnad", "avskrivning", "nedskrivning", "annen_driftskostnad", "sum_driftskostnader", "annen_rentekostnad", "rentekostnad_konsern", "annen_finanskostnad", "sum_finanskostnader", "skattekostnad"]

MAX_AMOUNT = 1e12


def join_pages(pages: DataFrame, keys: list[str], page: str = "page", text: str = "text") -> DataFrame:
    """One text for each document, pages in order with an empty line between them."""
    ordered = F.array_sort(F.collect_list(F.struct(page, F.coalesce(F.col(text), F.lit("")).alias("_t"))))
    return pages.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda p: p["_t"]), "\n\n").alias("text"))


TABLE_BARS, TABLE_AHEAD = 6, 500


def _first(text: Column, word: str) -> Column:
    """0-based place of a word (in lower case, as the text); null without one."""
    return F.nullif(F.locate(word, text) - 1, F.lit(-1))


def _before_table(text: Column, word: str) -> Column:
    """0-based place of the first occurrence that a table follows."""
    ahead = F.regexp_extract_all(text, F.lit(f"(?s)\\Q{word}\\E(?=(.{{0,{TABLE_AHEAD - len(word)}}}))"), F.lit(1))
    bars = TABLE_BARS - word.count("|")
    some = F.contains(text, F.lit(word)) & (F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))) >= TABLE_BARS)
    nth = F.array_position(F.transform(ahead, lambda w: F.length(w) - F.length(F.replace(w, F.lit("|"), F.lit(""))) >= bars), True).cast("int")
    place = F.get(F.transform(F.array(nth), lambda k: F.when(k > 0, F.length(F.array_join(F.slice(F.split(text, f"\\Q{word}\\E"), F.lit(1), k), word)))), F.lit(0))
    return F.when(some, place)


def section_start(low: Column, markers: list[str]) -> Column:
    """The first marker that a table follows (six bars in 500 characters), else the first marker; null without one.  ``low``: the text in lower case."""
    words = [m.lower() for m in markers]
    return F.coalesce(*(_before_table(low, w) for w in words), *(_first(low, w) for w in words))


def sections(docs: DataFrame, keys: list[str], markers: dict[str, list[str]] = SECTION_MARKERS) -> DataFrame:
    """One row for each section found: its start, its end (the next section's start) and its text."""
    starts = F.array(*(F.struct(F.lit(k).cast("int").alias("nth"), F.lit(s).alias("section"), section_start(F.col("_low"), m).alias("start")) for k, (s, m) in enumerate(markers.items())))
    found = docs.select(*keys, "text", F.lower("text").alias("_low")).select(*keys, "text", F.inline_outer(starts)).where("start is not null")  # outer: a plain one has all starts worked out again in a filter before it
    w = Window.partitionBy(*keys).orderBy("start", "nth")
    found = found.withColumn("end", F.coalesce(F.lead("start").over(w), F.length("text")))
    return found.select(*keys, "section", "start", "end", F.expr("substring(text, start + 1, end - start)").alias("chunk"))


def _once(value: Column) -> Column:
    """A value as a row of its own: filters on it are not moved before it, where they would work it out again for each place that names it."""
    return F.explode_outer(F.array(value))


def table_rows(chunks: DataFrame, keep: list[str], text: str = "chunk") -> DataFrame:
    """Lines with bars, cut in cells: (``keep``..., line, cells); rules and lines of under four parts are left out."""
    lines = chunks.select(*keep, F.posexplode(F.split(F.col(text), "\n")).alias("line", "_l")).withColumn("_l", F.trim("_l"))
    lines = lines.where(F.contains("_l", F.lit("|")) & ~F.startswith("_l", F.lit("|---")) & ~F.startswith("_l", F.lit("---")))
    cells = lines.select(*keep, "line", _once(F.transform(F.split("_l", r"\|"), lambda s: F.trim(s))).alias("cells"))
    return cells.where(F.size("cells") >= 4)


def label_of(cell: Column) -> Column:
    """A row's label in lower case, without note numbers and bars at its end."""
    bare = F.regexp_replace(F.trim(cell), r"\s*\|+$", "")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(bare, r"\|\s*[0-9,\s]*\s*\|", ""), r"\s+[0-9]+\s*$", "")))


def first_label(label: Column, rules: dict[str, str]) -> Column:
    """Key of the first rule whose pattern the label contains."""
    return F.coalesce(*(F.when(F.contains(label, F.lit(p)), F.lit(k)) for p, k in rules.items()))


#: Pairs of words that are counted first, letters of a head, the heads among which theirs is looked for, and words of a task where all pairs are counted.
PAIRS_FIRST, HEAD, HEADS, TASK_WORDS = 4_000_000, 3, 100_000, 4_000_000


def _words(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.split(F.coalesce(text, F.lit("")), " ").alias("w"))


def _pairs(rows: DataFrame, text: str) -> DataFrame:
    zipped = F.arrays_zip(F.slice("w", 1, F.size("w") - 1).alias("a"), F.slice("w", 2, F.size("w")).alias("b"))
    return _words(rows, text).where(F.size("w") > 1).select(F.inline_outer(zipped).alias("a", "b"))  # outer: a plain one zips once more in a filter before it


def _first_pairs(pairs: DataFrame, least: int, most: int) -> DataFrame:
    counted = pairs.select(F.concat("a", F.lit(" "), "b").alias("pattern")).groupBy("pattern").count()
    return counted.where(F.col("count") >= least).orderBy("count", "pattern").limit(most)


def rarest_pairs(rows: DataFrame, text: str, least: int, most: int) -> DataFrame:
    """(pattern, count) of the ``most`` first pairs of neighbouring words, by count and pattern, of those that are met ``least`` times or more.

    Words are what lies between spaces; a pattern is two of them with a space
    between.  Patterns met just ``least`` times come first, so once those up to
    some pattern are ``most``, no later pattern can be among the first.  The
    pairs of the first heads (how a pattern begins) are therefore counted by
    themselves, which leaves nearly all distinct pairs out of the shuffle.
    Where that does not give ``most``, all are counted, by tasks small enough
    to sum up their pairs in memory.
    """
    head = F.substring(F.concat("a", F.lit(" ")), 1, HEAD)  # in the order of the patterns, as no word has a space
    heads = _words(rows, text).select(F.explode("w").alias("a")).groupBy(head.alias("head")).count().orderBy("head").limit(HEADS)
    reached = heads.select("head", F.sum("count").over(Window.orderBy("head")).alias("n")).where(F.col("n") >= PAIRS_FIRST)
    bound = reached.agg(F.min("head")).first()[0]
    if bound is not None:
        some = materialize(_first_pairs(_pairs(rows, text).where(head <= bound), least, most), "pairs")
        if some.where(F.col("count") == least).count() == most:
            return some
        discard(some)
    size = _words(rows, text).agg(F.sum(F.size("w"))).first()[0] or 0
    tasks = max(-(-size // TASK_WORDS), rows.sparkSession.sparkContext.defaultParallelism)
    return _first_pairs(_pairs(rows.select(text).repartition(tasks), text), least, most)


#: Characters of patterns in one automaton (about a hundred times as much memory); more rules are matched in several rounds.
RULE_CHARS = 1 << 20


def first_rules(rows: DataFrame, text: str, rules: DataFrame) -> DataFrame:
    """Add ``ord`` and ``key`` of the first of many rules (ord, pattern, key) whose pattern the text contains; null without one.

    ``first_label`` looks for each pattern by itself; here an Aho-Corasick
    automaton finds all of them in one walk over the text, in Arrow batches,
    built once for each Python worker.  Rules are told apart by ``ord``, the
    smallest counts; empty or null patterns match nothing, a null text has no
    rule.
    """
    listed = rules.where("pattern <> '' and ord is not null").groupBy("pattern").agg(F.min(F.struct("ord", "key")).alias("r")).select("r.ord", "pattern", "r.key")
    listed = materialize(listed, "rules")  # read for its size, in each round and for the keys
    size = listed.agg(F.sum(F.length("pattern"))).first()[0] or 0
    rounds = -(-size // RULE_CHARS) or 1
    out = rows.withColumn("ord", F.lit(None).cast("long"))
    for k in range(rounds):  # each round holds a bounded share of the patterns
        part = {r["pattern"]: int(r["ord"]) for r in listed.where(F.pmod(F.xxhash64("pattern"), F.lit(rounds)) == k).collect()}
        out = _with_first(out, text, part)
    found = listed.groupBy("ord").agg(F.min("key").alias("key"))
    return out.join(F.broadcast(found) if size <= RULE_CHARS else found, "ord", "left").select(*rows.columns, "ord", "key")


@lru_cache(2)
def _automaton(patterns: tuple[tuple[str, int], ...]):
    import ahocorasick

    a = ahocorasick.Automaton()
    for pattern, nth in patterns:
        a.add_word(pattern, nth)
    if patterns:
        a.make_automaton()
    return a


def _with_first(rows: DataFrame, text: str, patterns: dict[str, int]) -> DataFrame:
    """Lower ``ord`` to that of the first pattern that the text holds."""
    listed = tuple(sorted(patterns.items()))

    def run(batches):
        a = _automaton(listed)
        for b in batches:
            found = []
            for t, known in zip(b[text].to_pylist(), b["ord"].to_pylist(), strict=True):
                own = min((nth for _, nth in a.iter(t)), default=None) if t and listed else None
                found.append(own if known is None else known if own is None else min(own, known))
            yield b.set_column(b.schema.get_field_index("ord"), "ord", pa.array(found, pa.int64()))

    return rows.mapInArrow(run, rows.schema)


def line_items(docs: DataFrame, keys: list[str], rules: dict[str, str] = LINE_ITEM_MAP) -> DataFrame:
    """(keys, item, current, prior) of each document (keys, text).

    Inside a section the first row of an item with an amount counts; of
    several sections the last.  Notes close a section but give no items.
    """
    rows = table_rows(sections(docs, keys).where("section <> 'notes'"), [*keys, "start"])
    rows = rows.select("*", _once(label_of(F.get("cells", F.lit(1)))).alias("label")).where(F.length("label") >= 3)
    rows = rows.select("*", _once(first_label(F.col("label"), rules)).alias("item")).where("item is not null")
    amounts = F.filter(F.transform(F.slice("cells", 3, F.size("cells")), cell_amount), lambda v: F.abs(v) < MAX_AMOUNT)
    cost = F.col("item").isin(COST_KEYS)
    rows = rows.select(*keys, "start", "line", "item", _once(amounts).alias("amounts"))
    rows = rows.select(*keys, "start", "line", "item", *(F.when(cost, F.abs(F.get("amounts", F.lit(k)))).otherwise(F.get("amounts", F.lit(k))).alias(c) for k, c in enumerate(("current", "prior"))))
    # a row with an amount comes before one without
    best = rows.groupBy(*keys, "start", "item").agg(F.min(F.struct(F.col("current").isNull().alias("none"), "line", "current", "prior")).alias("b"))
    last = best.groupBy(*keys, "item").agg(
        F.max(F.when(F.col("b.current").isNotNull(), F.struct("start", F.col("b.current").alias("v"))))["v"].alias("current"),
        F.max(F.when(F.col("b.prior").isNotNull(), F.struct("start", F.col("b.prior").alias("v"))))["v"].alias("prior"),
    )
    return last.where("current is not null or prior is not null")


def wide_items(items: DataFrame, keys: list[str], known: list[str]) -> DataFrame:
    """One row for each document, a column for each item and one ``_prior`` for last year's."""
    aggs = [F.max(F.when(F.col("item") == k, F.col(c))).alias(k + suffix) for k in known for c, suffix in (("current", ""), ("prior", "_prior"))]
    return items.groupBy(*keys).agg(*aggs)


def long_items(wide: DataFrame, keys: list[str], known: list[str]) -> DataFrame:
    """The reverse of ``wide_items``."""
    each = F.array(*(F.struct(F.lit(k).alias("item"), F.col(k).alias("current"), F.col(f"{k}_prior").alias("prior")) for k in known))
    return wide.select(*keys, F.inline(each)).where("current is not null or prior is not null")


def loaded_items(files: DataFrame, keys: list[str], raw: str = "value") -> DataFrame:
    """(keys, item, current, prior) of cached JSON objects, whose keys name items and, with ``_prior``, last year's."""
    meta = [*keys, "orgnr", "year", "revenue_label", "sections_found"]
    d = files.select(*keys, F.explode(F.from_json(raw, "map<string, string>")).alias("k", "v")).where(~F.col("k").isin(meta))
    prior = F.endswith("k", F.lit("_prior"))
    d = d.withColumns({"item": F.when(prior, F.regexp_replace("k", "_prior$", "")).otherwise(F.col("k")), "v": F.col("v").try_cast("double")})
    out = d.groupBy(*keys, "item").agg(F.max(F.when(~prior, F.col("v"))).alias("current"), F.max(F.when(prior, F.col("v"))).alias("prior"))
    return out.where("current is not null or prior is not null")


def loaded_excerpts(files: DataFrame, keys: list[str], raw: str = "value") -> DataFrame:
    """(keys, excerpts) of cached notes: the text between rules, without empty parts."""
    parts = F.split(F.coalesce(F.get_json_object(raw, "$.note_excerpts"), F.lit("")), "\n---\n")
    return files.select(*keys, F.filter(parts, lambda p: F.trim(p) != "").alias("excerpts"))


def _revenue_columns(sales: Column, other: Column) -> list[Column]:
    """``revenue_label`` and ``sections_found`` of documents whose text in lower case is ``_low``."""
    starts = {s: section_start(F.col("_low"), m) for s, m in SECTION_MARKERS.items()}
    fee = F.locate("salær", F.col("_low")) - 1
    label = F.when(sales, F.when((fee >= 0) & (fee < F.coalesce(starts["pnl"], F.length("text")) + 2000), "salær_provisjon").otherwise("salgsinntekt")).when(other, "annen_driftsinntekt_only")
    found = F.concat_ws(",", *(F.when(c.isNotNull(), F.lit(s)) for s, c in starts.items()))
    return [label.alias("revenue_label"), found.alias("sections_found")]


def revenue_labels(docs: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, revenue_label, sections_found): which kind of revenue leads, and the sections in fixed order."""
    has = items.where("current is not null").groupBy(*keys).agg(F.bool_or(F.col("item") == "salgsinntekt").alias("sales"), F.bool_or(F.col("item") == "annen_driftsinntekt").alias("other"))
    return docs.withColumn("_low", F.lower("text")).join(has, keys, "left").select(*keys, *_revenue_columns(F.col("sales"), F.col("other")))


def extracted(docs: DataFrame, wide: DataFrame, keys: list[str]) -> DataFrame:
    """``notes``, ``wide_items`` and ``revenue_labels`` of documents (keys, text) in one row each; texts and items are read once."""
    both = docs.withColumn("_low", F.lower("text")).join(wide, keys, "left")
    return both.select(*keys, *_note_columns(), *[c for c in wide.columns if c not in keys], *_revenue_columns(F.col("salgsinntekt").isNotNull(), F.col("annen_driftsinntekt").isNotNull()))


def notes(docs: DataFrame, keys: list[str]) -> DataFrame:
    """Disclosures of each document: client funds, netting, restricted funds, common costs, manager; excerpts around the hits."""
    return docs.select(*keys, *_note_columns())


def _note_columns() -> list[Column]:
    t = F.coalesce(F.col("text"), F.lit(""))
    client = has_any(t, ["klientmidl", "klientinnskudd", "klientkonto", "klientansvar"])
    restricted, shared = has_any(t, ["bundne"]), has_any(t, ["felleskostnad"])
    entrusted = has_any(t, ["betrodde midl"])
    held = F.when(client, F.coalesce(table_amount(t, "Klientinnskudd"), amount_near(t, "Innestående på klientkonto"), table_amount(t, "Klientmidler")))
    owed = F.when(client, F.coalesce(table_amount(t, "Klientansvar", True), table_amount(t, "Klientgjeld", True)))
    around = F.when(client, F.coalesce(context(t, "klientmidl"), context(t, "klientinnskudd"), context(t, "klientkonto")))
    return [
        (client | entrusted).alias("has_klientmidler"), held.alias("klientmidler_amount"), owed.alias("klientansvar_amount"), (held - F.abs(owed)).alias("klientkonto_balance"),
        has_any(t, ["nettopresentasjon", "regnskapsføres ikke i selskapets balanse"]).alias("has_nettopresentasjon"),
        restricted.alias("has_bundne_midler"),
        F.when(restricted, F.coalesce(table_amount(t, "bundne bankinnskudd"), amount_near(t, "bundne bankinnskudd"), amount_near(t, "bundne skattetrekksmidler"))).alias("bundne_midler_amount"),
        (has_any(t, ["forskrift om årsregnskap"]) & has_any(t, ["inkasso"])).alias("has_inkasso_forskrift"),
        shared.alias("has_felleskostnader"), F.when(shared, F.coalesce(table_amount(t, "felleskostnad"), amount_near(t, "felleskostnad"))).alias("felleskostnader_amount"),
        has_any(t, ["forretningsfører"]).alias("has_forretningsforer"),
        F.nullif(F.concat_ws("\n---\n", F.trim(around), F.trim(F.when(entrusted, context(t, "betrodde midl")))), F.lit("")).alias("note_excerpts"),
    ]
