"""Entry point for spark-submit; see ``earshot/__main__.py``."""

from earshot.__main__ import main

if __name__ == "__main__":
    main()
