"""Runs of which readers see the last complete one, whole.

A run writes its files under a folder of its own, `<folder>/run-<id>`. Publishing it replaces
one small file, `<folder>/_current`, that names the run; that is the only step readers can
notice. A run that stops before leaves the former one as it was. Old runs are removed
afterwards, but for the one before, which somebody may still be reading.
"""

import uuid

import pyarrow.fs

POINTER = "_current"


def file_system(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a folder that all executors share, and the path there."""
    short = folder.startswith("file:/") and not folder.startswith("file://")
    return pyarrow.fs.FileSystem.from_uri(folder.replace("file:/", "file:///", 1) if short else folder)


def new_run(folder: str) -> str:
    """Id of a new run; its folder exists and is empty."""
    run = uuid.uuid4().hex
    files, path = file_system(folder)
    files.create_dir(f"{path}/run-{run}")
    return run


def run_folder(folder: str, run: str) -> str:
    return f"{folder.rstrip('/')}/run-{run}"


def published(folder: str) -> list[str]:
    """Ids of the current run and the one before; none if no run was ever published."""
    files, path = file_system(folder)
    if files.get_file_info(f"{path}/{POINTER}").type == pyarrow.fs.FileType.NotFound:
        return []
    with files.open_input_stream(f"{path}/{POINTER}") as stream:
        return stream.read().decode().split()


def publish(folder: str, run: str) -> None:
    """Make `run` what readers see, and remove runs that were replaced before the last one.

    The pointer is written beside and moved into place. A run that another job has begun
    but not published is not touched, for it is not among the former ones.
    """
    files, path = file_system(folder)
    before = published(folder)
    if before[:1] == [run]:
        return
    keep = [run, *before[:1]]
    with files.open_output_stream(f"{path}/{POINTER}-{run}") as stream:
        stream.write("\n".join(keep).encode())
    files.move(f"{path}/{POINTER}-{run}", f"{path}/{POINTER}")
    for old in before[1:]:
        discard(folder, old)


def discard(folder: str, run: str) -> None:
    """Remove the files of a run that isn't published, or not any more."""
    files, path = file_system(folder)
    if files.get_file_info(f"{path}/run-{run}").type != pyarrow.fs.FileType.NotFound:
        files.delete_dir(f"{path}/run-{run}")


def current_folder(folder: str) -> str:
    """Folder of the published run."""
    runs = published(folder)
    if not runs:
        raise LookupError(f"no run was published in {folder}")
    return run_folder(folder, runs[0])
