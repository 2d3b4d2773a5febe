"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlegap.llm.ann import op6_multi_index_hashing
from candlegap.llm.fill_in_middle import ORACLE_OP12, op12_fill_in_middle
from candlegap.llm.fingerprints import op9_fingerprints
from candlegap.llm.html_text import op2_html_text
from candlegap.llm.language_id import op10_language_id
from candlegap.llm.merkle import ORACLE_OP11, op11_merkle
from candlegap.llm.mixing import ORACLE_OP7, op7_mixing
from candlegap.llm.ngram_join import op3_ngram_jaccard_join
from candlegap.llm.pii import op8_pii
from candlegap.llm.quality import op13_quality
from candlegap.llm.sentencepiece_codec import op1_sentencepiece
from candlegap.llm.token_files import op5_token_files
from candlegap.llm.warc import op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_html_text": op2_html_text,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_warc": op4_warc,
    "op5_token_files": op5_token_files,
    "op6_multi_index_hashing": op6_multi_index_hashing,
    "op7_mixing": op7_mixing,
    "op8_pii": op8_pii,
    "op9_fingerprints": op9_fingerprints,
    "op10_language_id": op10_language_id,
    "op11_merkle": op11_merkle,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_quality": op13_quality,
}

#: The others are tested against brute force, the libraries or held-out labels.
ORACLE_SQL: dict[str, str] = {"op7_mixing": ORACLE_OP7, "op11_merkle": ORACLE_OP11, "op12_fill_in_middle": ORACLE_OP12}
