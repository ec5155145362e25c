"""The star schema and marts as the documents describe them, in one build.

Beside the models that the original code builds: duplicates stay out of the SLA fact and of both
marts and are marked in the request fact, types without a target get the default one, the SLA fact
carries business days, and open tickets past their target are at risk.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ticketmill.operators import checks, facts, rules
from ticketmill.plans.build import Dimensions

CONTRACTS = {"mart_operational": checks.CONTRACT_DAILY, "mart_sla_performance": checks.CONTRACT_MONTHLY}


def request_fact(stg: DataFrame, star: Dimensions) -> DataFrame:
    """All tickets, duplicates marked; open ones past their target, the default one where the type
    has none, are at risk."""
    return facts.fct_service_requests(stg, star.request_type, star.department, star.status,
                                      mark_duplicates=True, default_days=rules.DEFAULT_TARGET_DAYS)


def sla_fact(stg: DataFrame, star: Dimensions) -> DataFrame:
    """Completed tickets that are no duplicates, with calendar and business days, judged against the
    type's target or the default one; ``sla_target_source`` says which."""
    fact = facts.fct_sla_performance(rules.without_duplicates(stg), star.request_type, star.department,
                                     default_days=rules.DEFAULT_TARGET_DAYS)
    return rules.with_business_days(fact, rules.business_day_numbers(star.date))


def models(stg: DataFrame, star: Dimensions, targets: DataFrame, end) -> dict[str, DataFrame]:
    """Facts and marts by name; the daily mart runs through ``end``."""
    return {
        "dim_request_type": rules.with_default_target(star.request_type),
        "fct_service_requests": request_fact(stg, star),
        "fct_sla_performance": sla_fact(stg, star),
        "mart_operational": rules.daily_backlog(stg, targets, star.geography, end),
        "mart_sla_performance": rules.monthly_sla(stg, targets, star.geography,
                                                  rules.business_day_numbers(star.date)),
    }


def check_contracts(built: dict[str, DataFrame]) -> DataFrame:
    """The result of both marts' contracts, with the model's name."""
    return checks.run_suites({name: (built[name], suite) for name, suite in CONTRACTS.items()})
