"""Job plans: analytic jobs (``jobs``), table work (``tables``), reports (``reports``)."""
