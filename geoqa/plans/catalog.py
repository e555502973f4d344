"""Import every plan module so the registry is complete."""

from geoqa.plans import registry
from geoqa.plans import checks_roads  # noqa: F401
from geoqa.plans import ops_geometry  # noqa: F401
from geoqa.plans import ops_joins  # noqa: F401
from geoqa.plans import ops_relational  # noqa: F401
from geoqa.plans import ops_cluster  # noqa: F401
from geoqa.plans import checks_attr  # noqa: F401
from geoqa.plans import checks_dist  # noqa: F401
from geoqa.plans import checks_shift  # noqa: F401
from geoqa.plans import checks_cluster  # noqa: F401
from geoqa.plans import checks_street  # noqa: F401
from geoqa.plans import ops_io  # noqa: F401
from geoqa.plans import reports  # noqa: F401  (last: it reads the other checks)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES
