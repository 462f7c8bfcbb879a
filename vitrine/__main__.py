import sys

from .plans.runner import main

sys.exit(main())
