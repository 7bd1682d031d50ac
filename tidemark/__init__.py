"""tidemark: a Spark-native real-time warehouse.

Raw JSON logs and database change records go in; cleaned facts, routed
dimension tables and ten-second summaries come out.  ``plans`` holds one
function per job, written on top of ``operators`` and ``functions``;
``sources`` and ``sinks`` connect jobs to topics, files and JDBC stores;
``streaming`` holds the stateful forms and the query runner.
"""

__version__ = "0.1.0"
