"""folioforge: encyclopedia page dumps to searchable documents, on Spark DataFrames.

Layers, from the bottom up:

* ``functions``  column expressions (text clean-up, box selection, field extraction)
* ``operators``  DataFrame -> DataFrame steps (pages, documents, index, search)
* ``sources``    readers and sinks (XML, CSV, JSON, keyed store)
* ``plans``      whole jobs made of the above, and the registered queries
* ``streaming``  the append sink as a file stream
"""

__version__ = "0.1.0"
