"""Layer builds, reports and jobs, composed of the operators."""
