"""Entry file for ``spark-submit``; see ``assaylake/__main__.py``."""

from assaylake.__main__ import main

main()
