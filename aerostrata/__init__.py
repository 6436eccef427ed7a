"""aerostrata: layered flight and customer analytics as Spark DataFrame operators.

Bronze tables are read with an enforced schema, Silver tables are cleaned
copies of them, Gold tables are marts for business questions, and the meta
layer holds the outcome of personal-data detection.  Every operator is a plain
``DataFrame -> DataFrame`` function without actions; only ``sources.catalog``
and ``plans.pipeline`` write.
"""
