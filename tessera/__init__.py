"""tessera — Spark-native batch analytics.

Every operator is a function from DataFrame(s) to a DataFrame built from
Spark SQL / DataFrame expressions, so Catalyst plans it and Tungsten runs
it.  Sub-packages:

* ``sources``   — table loaders, delimited/strict readers, file listing.
* ``sinks``     — text/CSV/Parquet/key-value writers and write modes.
* ``functions`` — column expressions (Java-style splits, Pearson, hashing).
* ``operators`` — collaborative filtering, predictions, text jobs, e-mail.
* ``plans``     — end-to-end jobs composed from the operators.
"""

__version__ = "0.1.0"
