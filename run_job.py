"""Entry file for spark-submit; see `billbook.__main__`."""

from billbook.__main__ import main

if __name__ == "__main__":
    main()
