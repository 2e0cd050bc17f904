"""Entry for spark-submit; see ``python run_job.py --help``."""

from jobsignals.__main__ import main

if __name__ == "__main__":
    main()
