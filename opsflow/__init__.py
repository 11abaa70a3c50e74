"""opsflow: bank-operations data jobs as plain Spark DataFrame transformations.

Four job families, each a set of ``DataFrame -> DataFrame`` operators:

* transaction categorization (``operators.feeds``, ``operators.latest``,
  ``operators.categorize``, ``operators.envelope``, ``streaming``),
* manifest-driven table transfer (``operators.transfer``, ``operators.runs``),
* use-case status dashboard (``operators.status``),
* cluster usage report (``operators.clusters``).

I/O lives in ``sources``; column-level helpers in ``functions``; the
bindings of operators to the driver's test tables in ``plans``.
"""

__version__ = "0.1.0"
