"""Daily incremental price calculation.

Each step is a function from DataFrames to a DataFrame and can be used alone:
``scope`` (which products and rules), ``changes`` (what moved on the date), ``discounts``
(fixed prices and layers), ``prices`` (tax, base price, formula), ``publish`` (checks and the
merge into the archive), ``run`` (all of it in order).
"""
