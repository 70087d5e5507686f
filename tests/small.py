"""Short model runs for the tests; the registered queries run the full settings."""

from listingguard.operators import models as mo
from listingguard.plans import catalog

PARAMS = mo.TreeParams(trees=10, learning_rate=0.2, depth=4)


def small_run(spark, sf_dir):
    return catalog.model_run(spark, sf_dir, PARAMS, PARAMS)
