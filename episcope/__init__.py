"""episcope: radiotherapy dose-and-fractionation statistics on Spark.

Stages: ``operators.episodes`` / ``operators.address`` / ``operators.extract``
build the classified extract; ``operators.clean`` and
``operators.aggregate`` turn it into the published long table;
``plans.monthly`` runs both with a file hand-over; ``catalog`` names every
operator as a query.
"""
