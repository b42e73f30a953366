"""spark-submit script of the jobs; see parcelake/jobs.py."""

from parcelake.jobs import main

if __name__ == "__main__":
    main()
