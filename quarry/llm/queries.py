"""Registered queries of the subpackage and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from quarry.llm import exact_dedup, line_dedup, phrases, turn_trie
from quarry.llm.common import read_table, spread

QUERIES: dict = {}
ORACLE: dict = {}


def register(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return keep


@register("op3_simhash_dedup")
def op3(spark, sf_dir):
    """Fingerprint and component of every document (3-word shingles, 2 bits)."""
    from quarry.llm.simhash import simhash_groups
    return simhash_groups(spread(read_table(spark, sf_dir, "documents")), shingle=3, max_bits=2)


@register("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity score of every document; labels of fold 0 held out."""
    from quarry.llm.toxicity import toxicity
    return toxicity(spread(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "labels"))


@register("op1_line_dedup", line_dedup.ORACLE_SQL)
def op1(spark, sf_dir):
    """All documents with only the earliest of equal and nearly equal lines."""
    return line_dedup.dedup_lines(spread(read_table(spark, sf_dir, "documents"))).select("doc_id", "text")


@register("op6_packing")
def op6(spark, sf_dir):
    """Windows of at most 2048 ids over all documents."""
    import public_tokenizers

    from quarry.llm.packing import pack_documents
    return pack_documents(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))


@register("op7_pii")
def op7(spark, sf_dir):
    """Personal data of every document."""
    from quarry.llm.pii import find_pii
    return find_pii(spread(read_table(spark, sf_dir, "documents")))


@register("op5_lang_id")
def op5(spark, sf_dir):
    """Language of every document; fold 2 held out."""
    from quarry.llm.lang_id import identify
    return identify(spread(read_table(spark, sf_dir, "documents")))


@register("op8_secret_scan")
def op8(spark, sf_dir):
    """Secrets of every document."""
    from quarry.llm.secret_scan import scan
    return scan(spread(read_table(spark, sf_dir, "documents")))


@register("op9_sentencepiece")
def op9(spark, sf_dir):
    """Ids of every document and whether they decode to its text."""
    import public_tokenizers

    from quarry.llm.pieces import round_trip
    return round_trip(spread(read_table(spark, sf_dir, "documents")), public_tokenizers.path("piece_bpe_32k.model"))


@register("op2_nearest_neighbours")
def op2(spark, sf_dir):
    """Ten nearest rows of every vector whose id is divisible by 100."""
    from quarry.llm.ann import nearest
    vectors = spread(read_table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


@register("op4_embedding_dedup")
def op4(spark, sf_dir):
    """Links with cosine >= 0.9 and components over all vectors."""
    from quarry.llm.nn_descent import near_duplicates
    return near_duplicates(spread(read_table(spark, sf_dir, "embeddings")), least=0.9)


@register("op11_exact_dedup", exact_dedup.ORACLE_SQL)
def op11(spark, sf_dir):
    """Document that stays, group size and digest of every document."""
    return exact_dedup.exact_groups(spread(read_table(spark, sf_dir, "documents")))


@register("op12_phrase_mining", phrases.ORACLE_SQL)
def op12(spark, sf_dir):
    """The 2000 best collocations of 2 to 5 words of every language."""
    return phrases.mine(spread(read_table(spark, sf_dir, "documents")))


@register("op13_conversation_trie", turn_trie.ORACLE_SQL)
def op13(spark, sf_dir):
    """Every node of the trie of the rebuilt conversations."""
    return turn_trie.conversation_trie(read_table(spark, sf_dir, "conversations")).drop("path")
