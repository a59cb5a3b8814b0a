"""Entry script for spark-submit."""

import sys

from tradewind.job import main

if __name__ == "__main__":
    sys.exit(main())
