"""cabmeter: ride-fare analytics expressed as Spark DataFrame, SQL, MLlib and
Structured Streaming plans.

Sub-packages:

* ``sources``   - table scans and writers (rides, route map, requests, Kafka).
* ``functions`` - ``Column -> Column`` helpers (calendar, features, surge, text).
* ``operators`` - DataFrame-level operators (cleaning, dashboard aggregates,
  routes, scenarios, model fitting and scoring).
* ``streaming`` - message decoding and streaming scoring.
* ``plans``     - the registered queries over the driver's test tables.
"""

__version__ = "0.1.0"
