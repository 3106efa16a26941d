"""newsledger: incremental article analytics expressed as Spark DataFrame plans.

Layout
------
sources/    typed readers with column contracts, config as data, test-table loader
functions/  pure ``Column -> Column`` builders (URL, HTML, text, numbers, dates,
            times, booleans, categories, model-reply parsing)
operators/  DataFrame -> DataFrame operators (anti-join, keyed update, dedupe,
            categorical cascade, schema validation, classification, reports)
plans/      end-to-end runs (incremental run, sinks) and the registered queries
streaming/  the available-now streaming form of the incremental run
"""

__version__ = "0.1.0"
