"""newslake: news and document analytics as plain Spark jobs.

Every operator takes DataFrames and returns a DataFrame, so it can be chained
with ``DataFrame.transform``.  Sub-packages:

* ``functions``  column functions (text, HTML, dates, similarity, vectors)
* ``sources``    table, file, feed and stream readers and writers
* ``operators``  filters, dedup, merge, statistics, health, corpus, vectors
* ``plans``      multi-step jobs built from the operators
* ``streaming``  Structured Streaming jobs
* ``catalog``    the registered queries with their SQL twins
"""
