from .base import Project
from .lending import Lending
from .revenue import Revenue
from .visits import Visits
from .workforce import Workforce

__all__ = ["Lending", "Project", "Revenue", "Visits", "Workforce"]
