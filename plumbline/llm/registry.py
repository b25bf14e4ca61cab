"""The registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from . import decontam, phrases, quotes, vectors, warc
from .bytecnn import op11_quality
from .decontam import op7_decontamination
from .licences import op5_licence_scan
from .media import op10_media_chunks
from .packing import op6_best_fit_packing
from .phrases import op13_phrases
from .quotes import op9_quotation_links
from .simhash import op8_simhash
from .substring import op1_substring_dedup
from .tokens import op3_token_ids
from .toxicity import op4_toxicity
from .vectors import op12_vector_codes
from .warc import op2_warc


def queries() -> dict:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_warc": op2_warc,
        "op3_token_ids": op3_token_ids,
        "op4_toxicity": op4_toxicity,
        "op5_licence_scan": op5_licence_scan,
        "op6_best_fit_packing": op6_best_fit_packing,
        "op7_decontamination": op7_decontamination,
        "op8_simhash": op8_simhash,
        "op9_quotation_links": op9_quotation_links,
        "op10_media_chunks": op10_media_chunks,
        "op11_quality": op11_quality,
        "op12_vector_codes": op12_vector_codes,
        "op13_phrases": op13_phrases,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.ORACLE, "op7_decontamination": decontam.ORACLE, "op9_quotation_links": quotes.ORACLE, "op12_vector_codes": vectors.oracle(), "op13_phrases": phrases.ORACLE}
