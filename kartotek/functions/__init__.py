"""Column functions used by every job."""

from kartotek.functions.roles import *  # noqa: F401,F403
from kartotek.functions.shapes import *  # noqa: F401,F403
from kartotek.functions.text import *  # noqa: F401,F403
from kartotek.functions.times import *  # noqa: F401,F403
from kartotek.functions.urls import *  # noqa: F401,F403
