"""``spark-submit run.py <job> ...``; see ``python run.py --help``."""

from chirpline.__main__ import main

if __name__ == "__main__":
    main()
