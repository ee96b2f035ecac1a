"""python -m tidemark bronze|silver ENTITY [--files DIR] | reconcile ENTITY CUTOFF; --environment NAME"""

from __future__ import annotations

import argparse

from tidemark.entities import ENTITIES
from tidemark.platform.config import ENVIRONMENTS, get_settings
from tidemark.platform.log import configure
from tidemark.plans import reconciliation
from tidemark.streaming import jobs


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    parser.add_argument("job", choices=("bronze", "silver", "reconcile"))
    parser.add_argument("entity", choices=sorted(ENTITIES))
    parser.add_argument("cutoff", nargs="?", default="")
    parser.add_argument("--files")
    parser.add_argument("--environment", choices=ENVIRONMENTS, default="local")
    args = parser.parse_args()
    configure(get_settings(args.environment).logging)
    if args.job == "bronze":
        jobs.run_bronze(args.entity, args.environment, args.files)
    elif args.job == "silver":
        jobs.run_silver(args.entity, args.environment)
    else:
        reconciliation.run(ENTITIES[args.entity], args.cutoff, args.environment)


if __name__ == "__main__":
    main()
