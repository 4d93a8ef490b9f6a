"""spark-submit entry point for the end-to-end catalogue job.

    zip -r stocktake.zip stocktake
    spark-submit --py-files stocktake.zip submit_catalog_job.py --csv <in> --out <out>
"""

from stocktake.plans.catalog_job import main

if __name__ == "__main__":
    main()
