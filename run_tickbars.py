"""Entry script for ``spark-submit``."""

from tickbars.plans.jobs import main

if __name__ == "__main__":
    main()
