"""Documents put together from their pages, cover sheets and model answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import yes_no
from ..sources.sections import SECTIONS
from .pages import MIN_GAPS, MIN_PAGES, REPORT_HEIGHTS, SOURCES, match_templates, page_types

# What stands for a platform where no footer tells, and the classifier's version.
NO_COMPANY_PAGE, ONE_COMPANY_PAGE = "brreg_only", "single_page_company"
CLASSIFIER_VERSION = "0.5.0"


def classified_pages(pages: DataFrame, doc: str, report_heights: list[int] | None = None) -> DataFrame:
    """Pages (doc, page, w, h, n_tables, max_col_gaps) with source, type and ``has_table``."""
    d = page_types(pages, doc, REPORT_HEIGHTS if report_heights is None else report_heights)
    has = F.when(F.col("type") == "generell_info", False).when(F.col("source") == SOURCES[0], True).when(F.col("type") == "revisjonsberetning", False).otherwise(F.coalesce(F.col("n_tables") > 0, F.lit(False)))
    return d.withColumn("has_table", has)


def document_manifest(pages: DataFrame, doc: str, templates: list[tuple[int, str]], within: int = 5) -> DataFrame:
    """One row for each document of its classified pages (with ``hash``, the footer's): split, platform, evidence of group accounts.

    The platform is told by the footer of the second company page; with one
    company page or none it has a name of its own.
    """
    company = F.col("source") == SOURCES[1]
    nth = F.sum(company.cast("int")).over(Window.partitionBy(doc).orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = pages.withColumn("_nth", F.when(company, nth))
    strong = company & (F.coalesce("max_col_gaps", F.lit(0)) >= MIN_GAPS)
    one = d.groupBy(doc).agg(
        F.count("*").alias("total_pages"), F.count_if(F.col("source") == SOURCES[0]).alias("n_brreg"), F.count_if(company).alias("n_company"),
        F.sort_array(F.collect_list(F.when(F.col("nested"), F.col("page")))).alias("nested_wrapper_pages"),
        F.max(F.when(F.col("_nth") == 2, F.col("hash"))).alias("hash"), F.count_if(strong).alias("konsern_evidence_pages"),
    )
    found = match_templates(one, templates, within)
    platform = F.when(F.col("n_company") == 0, NO_COMPANY_PAGE).when(F.col("n_company") == 1, ONE_COMPANY_PAGE).otherwise(F.col("template"))
    return found.select(
        doc, "total_pages", F.col("n_brreg").alias("brreg_last_page"), "n_brreg", "n_company", "nested_wrapper_pages", platform.alias("platform"),
        F.when((F.col("n_company") > 1) & F.col("hash").isNotNull(), F.lower(F.lpad(F.hex("hash"), 16, "0"))).alias("footer_hash"),
        (F.col("konsern_evidence_pages") >= MIN_PAGES).alias("konsern_detected"), "konsern_evidence_pages",
    )


def flat_manifest(documents: DataFrame, covers: DataFrame, keys: list[str]) -> DataFrame:
    """The manifest section's columns from document manifests and cover sheets (of the same keys; a document may have none)."""
    own = set(documents.columns)
    joined = documents.join(covers.select(*keys, *(c for c in covers.columns if c not in own)), keys, "left").withColumn("classifier_version", F.lit(CLASSIFIER_VERSION))
    known = dict(joined.dtypes)
    return joined.select(*(F.col(c).cast(t).alias(c) if c in known else F.lit(None).cast(t).alias(c) for c, t in SECTIONS["manifests"].items()))


def note_pages(pages: DataFrame) -> DataFrame:
    """Company pages with an image that are no auditor's report (pages without a type are kept)."""
    return pages.where((F.col("source") == SOURCES[1]) & ~F.col("type").eqNullSafe("revisjonsberetning") & F.col("has_image"))


ANSWER_SCHEMA = "split struct<brreg_last_page: int>, brreg map<string, string>, company map<string, string>, note_flags map<string, string>, revisjon map<string, string>, noter array<map<string, string>>"


def answer_rows(answers: DataFrame, keep: list[str], fields: dict[str, str], flags: dict[str, str], report: dict[str, str], answer: str = "answer") -> DataFrame:
    """One row for each section that a model's answer holds: its figures, and on the company's row note flags (``note_``) and report (``rev_``).

    Values that do not fit their type are null; an answer that is no JSON has
    no rows.
    """
    d = answers.select(*keep, F.from_json(answer, ANSWER_SCHEMA).alias("a"))
    sections = F.filter(F.array(*(F.struct(F.lit(s).alias("section"), F.col(f"a.{s}").alias("figures")) for s in SOURCES)), lambda s: s["figures"].isNotNull())
    d = d.select("*", F.inline(sections))
    company = F.col("section") == SOURCES[1]

    def of(values: Column, kinds: dict[str, str], prefix: str = "") -> list[Column]:
        return [F.try_element_at(values, F.lit(k)).try_cast(t).alias(prefix + k) for k, t in kinds.items()]

    return d.select(
        *keep, "section", F.coalesce("a.split.brreg_last_page", F.lit(0)).alias("split_page"), *of(F.col("figures"), fields),
        *of(F.when(company, F.col("a.note_flags")), flags, "note_"), *of(F.when(company, F.col("a.revisjon")), report, "rev_"),
        F.when(company, F.coalesce(F.size("a.noter"), F.lit(0))).alias("n_noter"),
    )


# Places of a cover sheet's fields (height, from, to), and what differs between its two layouts.
STABLE = {
    "journalnr": (469, 920, 1200), "orgnr_ocr": (575, 920, 1100), "organisasjonsform": (602, 920, 1300), "foretaksnavn": (635, 920, 1600), "adresse_1": (663, 920, 1600), "adresse_2": (693, 920, 1200),
    "start_1": (799, 920, 1100), "slutt_1": (799, 1100, 1350), "start_2": (828, 920, 1100), "slutt_2": (828, 1100, 1350),
}
SINGLE = {"morselskap": (903, 920, 1100), "smaa": (1010, 920, 1100), "regler": (1066, 920, 1500), "representant": (1170, 920, 1400), "dato": (1201, 920, 1200)}
GROUP = {"morselskap": (933, 920, 1100), "vedlagt": (961, 920, 1100), "smaa": (1068, 920, 1100), "regler": (1124, 920, 1500), "representant": (1232, 920, 1400), "dato": (1259, 920, 1200)}
NEAR_FIELD, NEAR_YEAR = 15, 10


def cover_by_position(words: DataFrame, doc: str) -> DataFrame:
    """Fields of cover sheets from recognised words (doc, text, x0, y0, x1), by where they stand.

    The layout with group accounts is told by a yes or no at its own height.
    Everything is one aggregation over a document's words.
    """
    ordered = F.array_sort(F.collect_list(F.struct("x0", "y0", "x1", "text")))
    d = words.groupBy(doc).agg(ordered.alias("w"))

    def at(place: tuple[int, int, int]) -> Column:
        y, low, high = place
        hit = F.filter("w", lambda w: (F.abs(w["y0"] - y) < NEAR_FIELD) & w["x0"].between(low, high))
        return F.nullif(F.trim(F.array_join(F.transform(hit, lambda w: w["text"]), " ")), F.lit(""))

    d = d.select(doc, "w", *(at(p).alias(f"_{k}") for k, p in STABLE.items()), *(at(p).alias(f"_one_{k}") for k, p in SINGLE.items()), *(at(p).alias(f"_all_{k}") for k, p in GROUP.items()))
    group = yes_no(F.col("_all_morselskap")).isNotNull()

    def either(k: str) -> Column:
        return F.when(group, F.col(f"_all_{k}")).otherwise(F.col(f"_one_{k}"))

    head = F.get(F.filter("w", lambda w: F.contains(w["text"], F.lit("REGNSKAPSÅRET"))), F.lit(0))
    year = F.filter("w", lambda w: (F.abs(w["y0"] - F.col("_head.y0")) < NEAR_YEAR) & (w["x0"] > F.col("_head.x1")) & F.regexp_like(w["text"], F.lit(r"^[0-9]+$")))
    second = F.col("_start_1").isNull()
    address = F.nullif(F.trim(F.concat_ws(" ", F.coalesce("_adresse_1", F.lit("")), F.coalesce("_adresse_2", F.lit("")))), F.lit(""))
    return d.withColumn("_head", head).select(
        doc, F.regexp_replace("_journalnr", r"^([^ ]*) ", "$1/").alias("journalnr"), F.replace("_orgnr_ocr", F.lit(" "), F.lit("")).alias("orgnr_ocr"), F.col("_organisasjonsform").alias("organisasjonsform"),
        F.col("_foretaksnavn").alias("foretaksnavn"), address.alias("forretningsadresse"), F.when(second, F.col("_start_2")).otherwise(F.col("_start_1")).alias("periode_start"),
        F.when(second, F.col("_slutt_2")).otherwise(F.col("_slutt_1")).alias("periode_slutt"), F.get(year, F.lit(0))["text"].try_cast("int").alias("regnskapsaar"),
        yes_no(either("morselskap")).alias("morselskap_i_konsern"), F.when(group, yes_no(F.col("_all_vedlagt"))).alias("konsernregnskap_vedlagt"), yes_no(either("smaa")).alias("regler_smaa_foretak"),
        either("regler").alias("regnskapsregler"), either("representant").alias("representant"), either("dato").alias("dato_fastsettelse"), F.exists("w", lambda w: F.contains(w["text"], F.lit("revideres"))).alias("fravalgt_revisjon"),
    )
