"""kinelake: cleaning and preparing episode-structured trajectories on Spark.

Layout: ``sources`` reads tables and files, ``functions`` holds Column and
numpy helpers, ``operators`` the DataFrame -> DataFrame operators, ``plans``
the composed stages and the registered queries, ``streaming`` the stateful
prefix mask.  ``llm`` is optional and nothing outside it imports it.
"""

__version__ = "0.1.0"
