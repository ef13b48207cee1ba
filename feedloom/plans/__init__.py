from feedloom.plans import bulk_load, extract, feed_cycle, inactivation

__all__ = ["bulk_load", "extract", "feed_cycle", "inactivation"]
