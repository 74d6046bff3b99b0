"""emporion: commerce-event analytics on Spark.

Every operator is a DataFrame -> DataFrame function built from Spark SQL
built-ins, so Catalyst sees (and optimises) the whole chain from raw event to
mart.  Sub-packages:

* ``sources``   - input adapters (test tables -> canonical raw tables), lake,
                  catalogue and Kafka-shaped readers, batch sinks.
* ``functions`` - reusable Column expressions (normalisation, tiers, rules).
* ``operators`` - staging, sessions, attribution, marts, hourly batch,
                  event-time windows, inventory, data quality.
* ``plans``     - the ordered model run and the registry of named queries.
* ``streaming`` - Structured Streaming wiring: parse -> rules -> sinks,
                  exact distinct windows, session windows, dedup, joins.
"""

__version__ = "0.1.0"
