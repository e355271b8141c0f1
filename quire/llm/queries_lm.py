"""Query ``op7_trie_lm``."""

from quire.llm.common import table
from quire.llm.trie_lm import scores


def op7_trie_lm(spark, sf_dir):
    return scores(table(spark, sf_dir, "documents"))


QUERIES = {"op7_trie_lm": op7_trie_lm}
