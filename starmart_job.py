"""Entry point for ``spark-submit``; ship the package with ``--py-files`` on a cluster."""

from starmart.jobs import main

if __name__ == "__main__":
    main()
