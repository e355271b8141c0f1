"""Query ``op4_perplexity_bands``."""

from quire.llm.common import table
from quire.llm.perplexity import quality_rules


def op4_perplexity_bands(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))


QUERIES = {"op4_perplexity_bands": op4_perplexity_bands}
