"""The queries of this folder, and those of them that SQL can express."""

from seqlog.llm.bpe import op2_bpe
from seqlog.llm.collocations import OP13_SQL, op13_collocations
from seqlog.llm.fill_middle import OP11_SQL, op11_fill_middle
from seqlog.llm.fingerprints import op10_fingerprints
from seqlog.llm.mixing import OP7_SQL, op7_mixing
from seqlog.llm.near_dedup import op1_near_dedup
from seqlog.llm.sharding import op6_sharding
from seqlog.llm.substrings import op4_substring_dedup
from seqlog.llm.token_counts import op9_token_counts
from seqlog.llm.top_k import OP8_SQL, op8_top_k
from seqlog.llm.toxicity import op5_toxicity
from seqlog.llm.url_filter import OP3_SQL, op3_url_filter
from seqlog.llm.warc import OP12_SQL, op12_warc


def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "pipeline": pipeline,
    "op1_near_dedup": op1_near_dedup,
    "op2_bpe": op2_bpe,
    "op3_url_filter": op3_url_filter,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_mixing": op7_mixing,
    "op8_top_k": op8_top_k,
    "op9_token_counts": op9_token_counts,
    "op10_fingerprints": op10_fingerprints,
    "op11_fill_middle": op11_fill_middle,
    "op12_warc": op12_warc,
    "op13_collocations": op13_collocations,
}
ORACLE: dict[str, str] = {
    "op3_url_filter": OP3_SQL,
    "op7_mixing": OP7_SQL,
    "op8_top_k": OP8_SQL,
    "op11_fill_middle": OP11_SQL,
    "op12_warc": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
