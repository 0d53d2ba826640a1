"""Every operator as a query over the given tables, each with the SQL it must agree with."""

from catalogue import cleaning, derived, models, runs, sections


def all_cases():
    found = {}
    for module in (cleaning, models, derived, sections, runs):
        for name, case in module.cases().items():
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = case
    return found
