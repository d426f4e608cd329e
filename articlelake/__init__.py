"""articlelake: scholarly article files and crawled journal pages as one Spark table."""

from pyspark import cloudpickle

from articlelake import fixed_values
from articlelake.functions import html_fields, tei_fields

# The two per-document helpers travel with the tasks, so executors need no
# installed copy of this package.
for _module in (fixed_values, tei_fields, html_fields):
    cloudpickle.register_pickle_by_value(_module)
