"""All registered queries."""

from detlake.plans import (box_queries, capture_queries, dataset_queries, eval_queries, evalmap_queries,  # noqa: F401
                           registry_queries, run_queries)
from detlake.plans.catalog import jobs, oracles  # noqa: F401
