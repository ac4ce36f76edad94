"""The rental shop's tables derived from order data, once for Spark and once as SQL for the checks."""
