"""The batch jobs and studies, composed from operators."""
