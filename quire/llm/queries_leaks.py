"""Query ``op1_decontaminate``."""

from quire.llm.common import table
from quire.llm.decontaminate import contaminated


def op1_decontaminate(spark, sf_dir):
    """Documents that hold a test item or an edited copy of it, with the item."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
