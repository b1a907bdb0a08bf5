"""Launcher for spark-submit: ``zip -qr strata.zip strata && spark-submit --py-files strata.zip launch.py markets ...``."""

from strata.__main__ import main

if __name__ == "__main__":
    main()
