"""Query ``op9_quality_net``."""

from quire.llm.common import table
from quire.llm.quality_net import quality_scores


def op9_quality_net(spark, sf_dir):
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op9_quality_net": op9_quality_net}
