"""riskloom: customer-risk analytics jobs expressed as Spark DataFrame plans.

Every public job is a function from DataFrames (plus plain parameters such as an
``as_of`` date or a threshold) to a lazy DataFrame.  Nothing collects row-level data
to the driver; the only eager steps are small, bounded lookups that are called out
where they happen.
"""

__all__ = ["session"]
