"""The extraction store's sections: their columns, and writers that keep to them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .sinks import append_section, coerce

_KEYS = {"pdf_sha256_prefix": "string", "orgnr": "string", "year": "int"}
_COST = {"extraction_model": "string", "extraction_cost_usd": "double", "input_tokens": "int", "output_tokens": "int"}

# Columns of the sections; the run's date and time are added on writing.
SECTIONS: dict[str, dict[str, str]] = {
    "manifests": _KEYS | {
        "journalnr": "string", "regnskapsaar": "int", "periode_start": "string", "periode_slutt": "string", "foretaksnavn": "string", "organisasjonsform": "string",
        "morselskap_i_konsern": "boolean", "konsernregnskap_vedlagt": "boolean", "regler_smaa_foretak": "boolean", "regnskapsregler": "string", "fravalgt_revisjon": "boolean",
        "dato_fastsettelse": "string", "regnskapsforer": "string", "total_pages": "int", "brreg_last_page": "int", "n_brreg": "int", "n_company": "int", "platform": "string",
        "footer_hash": "string", "konsern_detected": "boolean", "konsern_evidence_pages": "int", "classifier_version": "string", "file_size_bytes": "bigint",
    },
    "brreg_financials": _KEYS | {"section": "string"} | dict.fromkeys([
        "salgsinntekt", "annen_driftsinntekt", "sum_driftsinntekter", "lonnskostnad", "avskrivning", "annen_driftskostnad", "sum_driftskostnader", "driftsresultat", "sum_finansinntekter",
        "sum_finanskostnader", "resultat_for_skatt", "skattekostnad", "aarsresultat", "sum_anleggsmidler", "sum_omlopsmidler", "sum_eiendeler", "sum_egenkapital", "sum_langsiktig_gjeld",
        "sum_kortsiktig_gjeld", "sum_gjeld",
    ], "bigint") | _COST,
    "noter": _KEYS | {
        "note_nr": "string", "tittel": "string", "note_type": "string", "has_table": "boolean", "page_refs": "string", "raw_amounts_json": "string", "raw_text": "string", "sub_tables_json": "string",
    } | _COST,
    "note_flags": _KEYS | {
        "antall_ansatte": "int", "antall_aarsverk": "double", "otp_pliktig": "boolean", "revisjonshonorar_revisjon": "bigint", "bundne_midler_amount": "bigint", "skattetrekkskonto": "bigint",
        "has_pantstillelser": "boolean", "pantstillelser_gjeld": "bigint", "pantstillelser_bokfort": "bigint", "utbytte": "bigint", "konsernbidrag": "bigint", "fortsatt_drift_tvil": "boolean",
        "kassekredittlimit": "bigint", "kassekreditt_benyttet": "bigint", "klientmidler": "bigint", "hendelser_etter_balansedagen": "string", "extraction_model": "string",
        "extraction_cost_usd": "double", "n_note_pages": "int",
    },
    "revisjon": _KEYS | {"revisor": "string", "firma": "string", "konklusjon": "string", "fravalgt": "boolean", "presisering": "string"},
    "raw_responses": _KEYS | {
        "journalnr": "string", "raw_response": "string", "status": "string", "input_tokens": "int", "output_tokens": "int", "cost_usd": "double", "finish_reason": "string",
        "extractor_version": "string", "n_note_pages": "int", "n_notes_found": "int", "error": "string",
    },
}


def section_rows(df: DataFrame, section: str) -> DataFrame:
    """Exactly the columns of a section: unknown ones go, missing ones and values that do not fit are null."""
    return coerce(df, SECTIONS[section])


def write_section(df: DataFrame, store: str, section: str, collection_date: str, collection_time: str) -> None:
    """Append records to a section under the run's date and time."""
    append_section(df, store, section, SECTIONS[section], collection_date, collection_time)
