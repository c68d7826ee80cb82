"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (divergence, exact_dedup, fingerprint, html_layout, language_id, near_dedup, packing,
               plane_clustering, repeats, secret_scan, sentencepiece_fst, token_count, topk_search)
from .common import documents, embeddings

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {
    "op1_sentencepiece": lambda s, d: sentencepiece_fst.round_trip(documents(s, d), PIECES),
    "op2_language_id": lambda s, d: language_id.identify(documents(s, d)),
    "op3_minhash_near_dedup": lambda s, d: near_dedup.near_dedup(documents(s, d)),
    "op4_secret_scan": lambda s, d: secret_scan.digest(secret_scan.detect(documents(s, d))),
    "op5_best_fit_packing": lambda s, d: packing.pack(documents(s, d), WORD_BPE),
    "op6_fingerprints": lambda s, d: fingerprint.edited_fingerprints(documents(s, d)),
    "op7_suffix_array_dedup": lambda s, d: repeats.digest(repeats.kept_bytes(documents(s, d)))
    .withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))
    .withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept"),
    "op8_exact_dedup": lambda s, d: exact_dedup.decide(documents(s, d)),
    "op9_token_counts": lambda s, d: token_count.count_tokens(documents(s, d), PIECES),
    "op10_html_extraction": lambda s, d: html_layout.extract(s.read.parquet(f"{d}/pages.parquet")),
    "op11_plane_clustering": lambda s, d: plane_clustering.report(embeddings(s, d)),
    "op12_source_divergence": lambda s, d: divergence.audit(documents(s, d)),
    "op13_topk_search": lambda s, d: topk_search.top_k(embeddings(s, d)),
}

ORACLES = {
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_plane_clustering": plane_clustering.oracle(),
    "op12_source_divergence": divergence.ORACLE,
    "op13_topk_search": topk_search.ORACLE,
}
