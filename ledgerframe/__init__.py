"""ledgerframe: brokerage-statement analytics as Spark DataFrame jobs.

Layers (each a set of pure ``DataFrame -> DataFrame`` functions):

* ``sources``   - statement landing (workbooks, CSV/Parquet), benchmark series,
                  and the adapter from the driver's TPC-H-style tables.
* ``operators`` - staging, intermediate/mart transforms, benchmark maths,
                  report sections and data-quality checks.
* ``plans``     - composition of the operators into marts and a full run.
* ``sinks``     - partitioned Parquet writers for raw tables, marts, report.
* ``llm``       - training-data operators; nothing else imports them.
"""

__version__ = "0.2.0"
